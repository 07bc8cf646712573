import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hypeline.llm import sharding

from .cases import SF, awkward, nothing


def test_curve_visits_every_cell_and_moves_one_step(spark):
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = spark.range(side ** dims)
        point = [F.floor(F.col("id") / side ** k).cast("long") % side for k in range(dims)]
        rows = cells.select(*[p.alias(f"x{k}") for k, p in enumerate(point)],
                            sharding.hilbert_index(point, bits).alias("h")).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(side ** dims))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[k] - b[k]) for k in range(dims)) == 1


def test_log_grid_is_monotone(spark):
    rows = spark.range(0, 5000).select(sharding.log_grid(F.col("id")).alias("g")).collect()
    grid = [r.g for r in rows]
    assert grid == sorted(grid) and grid[0] == 0 and len(set(grid)) > 60


def check(docs, shards):
    rows = sharding.assign_shards(docs, shards).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    want = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    return rows


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = check(docs, 16)
    assert Counter(first) == Counter(sharding.assign_shards(docs.repartition(7), 16).collect())


def test_awkward_rows(spark, scratch):
    docs = awkward(spark)
    check(docs, 4)
    check(docs, 40)
    out = sharding.attach_shards(docs, sharding.assign_shards(docs, 4))
    assert sorted(out.columns) == sorted([*docs.columns, "slot"])
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert len({(r["shard"], r["slot"]) for r in out.collect()}) == out.count()
    path = scratch("shards")
    sharding.write_shards(docs, path, 4, rows_per_file=2)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()


def test_empty(spark):
    assert sharding.assign_shards(nothing(spark)).count() == 0
