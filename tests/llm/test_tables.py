"""Chat formatting and URL filters, and the SQL twins of the numbered operators."""

import datetime
import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import compare as tool
from slotwise.llm import chat, urlfilter
from slotwise.llm.queries import PROBE, QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name, monkeypatch):
    monkeypatch.setattr(tool, "QUERIES", QUERIES)
    monkeypatch.setattr(tool, "SQL", SQL)
    assert tool.compare(spark, tool.connect(sf), name, sf) == ""


TURNS = [
    (1, 0, "user", PROBE),
    (1, 1, "assistant", r"<\s> <s> </s> [\\INST] [/INST]" + PROBE),
    (1, 2, "assistant", ""),
    (1, 3, None, "no role"),
    (2, 5, "assistant", None),
    (2, 5, "assistant", "a tie"),
    (2, 5, "assistant", "a tie"),
    (2, None, "sys<s>tem[INST]", "null turn"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "é😀" * 50_000),
    (3, 0, "user", "[" * 300 + "\\" * 300 + "INST]"),
    *[(4, i, "assistant" if i % 2 else "user", f"turn {i} <s") for i in range(300)],
]
SHAPE = "conv_id bigint, turn bigint, role string, text string, Turn int, seq int, formatted string"


def test_conversations_read_back(spark):
    df = spark.createDataFrame([(*t, 1, 2, "clash") for t in TURNS], SHAPE)
    got = {r.conv_id: r for r in chat.read_back(chat.conversations_table(chat.turn_events(df))).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in sorted(TURNS, key=lambda t: (t[0] or -1, -1 if t[1] is None else t[1], t[2] or "", t[3] is not None, t[3] or "")):
        want[conv].append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [tuple(t) for t in got[conv].turns] == turns
        assert got[conv].learned == "".join(t for r, t in turns if r == "assistant")
        assert got[conv].formatted.count("<s>") == len(turns)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<>[]/\\sINST \né", max_size=30), min_size=1, max_size=20))
def test_escapes_are_exact(spark, said):
    df = spark.createDataFrame([(t,) for t in said], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.t and not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_fold_of_a_log(spark):
    log = [
        (1, 1, 1, "delta", "user", "Hel"),
        (1, 2, 1, "delta", "user", "lo"),
        (1, 3, 2, "delta", "assistant", "first try"),
        (1, 5, 2, "delta", "assistant", "second"),
        (1, 4, 2, "regenerate", "assistant", "ignored"),
        (1, 6, 1, "edit", "user", "Good day"),
        (1, 7, 1, "delta", "user", "!"),
        (1, None, 3, "delta", None, "no sequence"),
        (1, 9, 2, "delta", "assistant", None),
        (2, 1, 1, "regenerate", "assistant", "x"),
    ]
    df = spark.createDataFrame(log, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(df).collect()}
    assert got == {(1, 1): ("user", "Good day!"), (1, 2): ("assistant", "second"), (1, 3): ("", "no sequence"), (2, 1): ("assistant", "")}
    empty = spark.createDataFrame([], "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    assert chat.read_back(chat.conversations_table(empty)).count() == 0


def test_probe_conversation(spark, sf):
    row = QUERIES["op6_chat_format"](spark, sf).where("conv_id = -7").first()
    said = f"user\n{PROBE}\nassistant\n{PROBE}\n"
    assert (row.n_turns, row.loss_chars) == (2, len(PROBE))
    assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and row.loss_sha256 == hashlib.sha256(PROBE.encode()).hexdigest()


def test_native_plans(spark, sf):
    """Marked operators run without Python on the executors."""
    for name in ("op2_url_filter", "op6_chat_format"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_url_filter(spark):
    day = lambda n: None if n is None else datetime.date(2024, 1, n)
    entries = [
        ("block", "Bad.example", "add", 5), ("block", "bad.example", "remove", 10), ("block", "bad.example", "add", 20),
        ("block", "bad.example", "add", 20), ("allow", "ok.bad.example", "add", 1), ("block", "ok.bad.example", "add", 25),
        ("block", "same.org", "add", 3), ("block", "same.org", "remove", 3), ("block", "", "add", 1), ("block", None, "add", 1),
        ("block", "late.org", "add", None), ("other", "x.org", "add", 1), ("block", "x.org", "wrong", 1), (None, "x.org", "add", 1),
    ]
    pages = [
        ("http://bad.example/x", 4), ("http://bad.example/x", 5), ("http://u:p@www.BAD.example.:80/", 9), ("https://bad.example?q", 10),
        ("https://bad.example#f", 31), ("ftp://a.ok.bad.example", 24), ("ftp://a.ok.bad.example", 25), ("https://notbad.example/", 6),
        (None, 6), ("", 6), ("no url at all", 6), ("http://bad.example", None), ("http://same.org", 4), ("http://late.org", 4), ("http://x.org", 9),
        ("http://bad.example/x", 5),
    ]
    log = spark.createDataFrame([(a, b, c, day(d), "clash") for a, b, c, d in entries], "list string, value string, action string, dated date, host string")
    shot = spark.createDataFrame([(None if i == 1 else i, u, day(d), "clash", 1) for i, (u, d) in enumerate(pages)], "page_id bigint, url string, fetched date, host string, URL int")
    got = Counter((r.page_id, r.verdict, r.matched) for r in urlfilter.filtered(shot, log).collect())
    bad = "bad.example"
    want = ["none", "block", "block", "none", "block", "allow", "block", "none", "none", "none", "none", "none", "none", "none", "none", "block"]
    value = {1: bad, 2: bad, 4: bad, 5: "ok.bad.example", 6: "ok.bad.example", 15: bad}
    assert got == Counter((None if i == 1 else i, w, value.get(i)) for i, w in enumerate(want))
    assert urlfilter.filtered(shot, log.limit(0)).where("verdict <> 'none'").count() == 0
    assert urlfilter.filtered(shot.limit(0), log).count() == 0


def test_url_filter_addresses(spark):
    since = datetime.date(2024, 1, 1)
    values = ["10.1.2.3", "2.3", "[2001:db8::1]", "[", "4.example"]
    log = spark.createDataFrame([("block", v, "add", since) for v in values], "list string, value string, action string, dated date")
    want = {
        "http://10.1.2.3:80/x": ("10.1.2.3", "10.1.2.3"), "http://9.1.2.3/": ("9.1.2.3", None), "http://u@[2001:DB8::1]:8080/": ("[2001:db8::1]",) * 2,
        "http://[2001:db8::2]/": ("[2001:db8::2]", None), "http://[::ffff:9.1.2.3]/": ("[::ffff:9.1.2.3]", None), "http://1.2.3.4.example/": ("1.2.3.4.example", "4.example"),
        "http://2.3/": ("2.3", "2.3"),
    }
    shot = spark.createDataFrame([(i, u, since) for i, u in enumerate(want)], "page_id bigint, url string, fetched date")
    got = {r.page_id: (r.host, r.matched) for r in urlfilter.filtered(shot, log).collect()}
    assert got == dict(enumerate(want.values()))
    assert urlfilter.entries_of(shot).where("value rlike '^[0-9]+\\\\.[0-9]+$' and value <> '2.3'").count() == 0
