import zlib
from collections import Counter, defaultdict

from fundlens.llm import sharding


def check(df, rows):
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in df.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_all_rows_have_a_place(spark, documents, odd_documents):
    for df in (documents, odd_documents, odd_documents.limit(0)):
        check(df, sharding.assign(df).collect())


def test_shards_are_near_equal(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 700 as int)) AS text")
    held = Counter()
    for r in sharding.assign(df).collect():
        held[r.shard] += r.size
    mean = sum(held.values()) / 40
    assert len(held) == 40 and max(held.values()) < 1.01 * mean and min(held.values()) > 0.99 * mean


def test_reruns_agree(documents):
    assert sorted(sharding.assign(documents).collect()) == sorted(sharding.assign(documents.repartition(5)).collect())


def test_maps_change_only_where_needed(spark, tmp_path):
    sizes = [(i * 7919) % 1000 for i in range(2000)]
    old = sharding.first_map(2000, 10)
    assert sharding.rebalanced(old, [5] * 2000, 10) == old
    new = sharding.rebalanced(old, sizes, 10)
    held = Counter()
    for slot, shard in enumerate(new):
        held[shard] += sizes[slot]
    assert max(held.values()) - min(held.values()) <= 1000
    more = sharding.grown(new, sizes, 10)
    moved = [s for s in range(2000) if more[s] != new[s]]
    assert moved and all(more[s] == 10 for s in moved)
    share = sum(sizes[s] for s in moved) / sum(sizes)
    assert 0.08 < share <= 1 / 11
    sharding.write_map(spark, str(tmp_path), 1, old)
    sharding.write_map(spark, str(tmp_path), 2, new)
    assert sharding.read_map(spark, str(tmp_path), 1) == old and sharding.read_map(spark, str(tmp_path), 2) == new


def test_equal_rows_spread(spark, monkeypatch):
    """2,000 rows alike in all columns, beside others."""
    monkeypatch.setattr(sharding, "EQUAL_AT_ONCE", 300)
    df = spark.range(20_000).selectExpr("IF(id < 2000, NULL, id) AS doc_id", "IF(id < 2000, 'same', repeat('x', 20)) AS text")
    rows = sharding.assign(df).collect()
    check(df, rows)
    same, held = Counter(r.shard for r in rows if r.doc_id is None), Counter()
    for r in rows:
        held[r.shard] += r.size
    assert len(same) == 40 and max(same.values()) < 200
    mean = sum(held.values()) / 40
    assert max(held.values()) < 1.01 * mean and min(held.values()) > 0.99 * mean


def test_a_stored_map_is_edited(spark, tmp_path):
    folder = str(tmp_path / "map")
    df = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 700 as int)) AS text")
    first = {r.doc_id: r.shard for r in sharding.assign(df, map_folder=folder).collect()}
    assert sharding.newest_version(spark, folder) == 2
    assert {r.doc_id: r.shard for r in sharding.assign(df, map_folder=folder).collect()} == first
    # a tenth more rows: most stay where they were
    more = df.union(spark.range(20_000, 22_000).selectExpr("id AS doc_id", "repeat('y', 900) AS text"))
    rows = sharding.assign(more, map_folder=folder).collect()
    check(more, rows)
    assert sum(first.get(r.doc_id, r.shard) != r.shard for r in rows) < 2_000
    assert sharding.newest_version(spark, folder) == 3 and sharding.read_map(spark, folder, 1) == sharding.first_map(sharding.SLOTS, 40)
