"""What changed is worked out once, however many joins go on from it."""

from fundlens.operators import market
from fundlens.plans import changes
from fundlens.sources.loads import write_load
from fundlens.sources.tables import read_table
from test_commits import prices, rows_of


def counted(df):
    """df, and how many of its rows have been made."""
    made = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), made


def test_changes_are_found_once(spark, tmp_path):
    root = str(tmp_path)
    write_load(prices(spark, [(i, d, 5 + d % 7) for i in (1, 2, 3) for d in range(100)]), root, "prices", "l1")
    write_load(prices(spark, [(i, d, 9 + i) for i in (1, 2) for d in range(100, 110)]), root, "prices", "l2")
    average = lambda rows: market.moving_average(rows, 5)
    keys, made = counted(changes.changed_keys(spark, root, 1))
    first = changes.first_changes(keys)
    new = changes.recomputed_windows(spark, root, first, 4, average)
    kept = changes.maintained_windows(average(read_table(spark, root, "prices", version=1)), new, first)
    assert rows_of(kept) == rows_of(average(read_table(spark, root, "prices")).select(*kept.columns))
    assert made.value == 20
