import numpy as np
import pytest

from tidemark.operators import postprocess
from tidemark.streaming import stateful


@pytest.fixture(scope="module")
def frames():
    p = np.random.default_rng(6).dirichlet(np.ones(4) * 0.4, 60)
    return [(s, i, row.tolist()) for s in (1, 2) for i, row in enumerate(p[s - 1 :: 2])]


def loop(rows, alpha=0.3, margin=0.2, unknown=1):
    e, last, quiet, out = np.zeros(4), -1, 0, []
    for p in rows:
        e = alpha * np.array(p) + (1 - alpha) * e
        top = int(e.argmax())
        if top == unknown:
            alt = max((c for c in range(4) if c != unknown), key=lambda c: (e[c], -c))
            if e[top] - e[alt] < margin:
                top = alt
        fired = False
        if top in (0, unknown):
            quiet += 1
            last = -1 if quiet >= 3 else last
        else:
            quiet, fired, last = 0, top != last, top
        out.append((top, fired))
    return out


def run_stream(spark, tmp_path, parts, schema, operator, name):
    """Feed the parts as one file each, a trigger a file."""
    source = tmp_path / name
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(source))
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    q = operator(df).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.table(name).collect()


def test_margin_average_stream_equals_batch_and_loop(spark, frames, tmp_path):
    schema = "stream long, pos long, p array<double>"
    batch = stateful.batch(spark.createDataFrame(frames, schema)).collect()
    for s in (1, 2):
        got = [(r.pred, r.event) for r in sorted(batch, key=lambda r: r.pos) if r.stream == s]
        assert got == loop([p for k, _, p in frames if k == s])
    parts = [[f for f in frames if lo <= f[1] < lo + 10] for lo in (0, 10, 20)]
    rows = run_stream(spark, tmp_path, parts, schema, stateful.stream, "margin")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, batch))


def test_median3_stream_equals_batch(spark, tmp_path):
    x = np.random.default_rng(2).normal(size=30).round(3).tolist()
    rows = [(1, i, v) for i, v in enumerate(x)]
    schema = "stream long, pos long, x double"
    want = [(r.pos, r.y) for r in postprocess.median3(spark.createDataFrame(rows, schema)).orderBy("pos").collect()]
    got = run_stream(spark, tmp_path, [rows[:7], rows[7:8], rows[8:]], schema, stateful.median3_stream, "median")
    assert sorted((r.pos, r.y) for r in got) == want
