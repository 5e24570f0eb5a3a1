import pyarrow as pa

from hitledger.llm.textbytes import powers, tidy


def test_a_task_leaves_no_powers_behind(spark):
    """A worker lives on beside the tasks of other stages; what a task grew is given back."""
    def kept() -> int:
        import sys

        return len(getattr(sys.modules.get("_hitledger_powers"), "up", ()))

    def grow(batches):
        for batch in batches:
            powers(1_000_000)
            yield batch

    def left(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([kept()] * batch.num_rows, pa.int64())], names=["n"])

    rows = spark.range(0, 8, 1, 8)
    assert rows.mapInArrow(tidy(spark, grow), "id long").count() == 8
    assert {r.n for r in rows.mapInArrow(left, "n long").collect()} == {0}
