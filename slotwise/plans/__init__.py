"""The named queries. Each takes DataFrames with the columns of `slotwise.schemas` and returns one."""
