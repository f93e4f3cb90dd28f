import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import features as bank
from tidemark.functions import parsing
from tidemark.operators import events, labels, postprocess, resample
from tidemark.operators import sequence as seq
from tidemark.plans import catalogue


def recording(spark, values, session="a"):
    n = len(values)
    return spark.createDataFrame([(session, i, n, v) for i, v in enumerate(values)], "session string, pos long, n long, label long")


def brute_pure(values, w, shift):
    out = {v: 0 for v in values}
    total = 0
    for s in range(0, len(values) - w + 1, shift):
        total += 1
        if len(set(values[s : s + w])) == 1:
            out[values[s]] += 1
    return out, total


@pytest.mark.parametrize(("w", "shift"), [(20, 20), (5, 3), (1, 1), (40, 7)])
def test_pure_windows_match_brute_force(spark, w, shift):
    values = [0] * 60 + [1] * 12 + [0] * 30 + [1] * 12 + [2] * 60
    got = seq.pure_windows(recording(spark, values), w, shift).collect()
    want, total = brute_pure(values, w, shift)
    assert {r.label: r.pure_windows for r in got} == want
    assert {r.total_windows for r in got} == {total}


def test_yield_of_fragmented_class(spark):
    values = [0] * 120 + ([1] * 20 + [2] * 4) * 6 + [2] * 96
    assert {r.label: r.windows for r in seq.window_yield(recording(spark, values), 20).collect()} == {0: 6, 1: 2, 2: 5}


def test_time_order(spark):
    rows = [("a", i, 6, t) for i, t in enumerate([0.0, 1.0, 2.0, 3.0, 1.5, 4.0])] + [("b", i, 3, t) for i, t in enumerate([2.0, 1.0, 0.0])] + [("c", 0, 1, 5.0)]
    df = spark.createDataFrame(rows, "session string, pos long, n long, t double")
    assert {r.session: r.bad_steps for r in seq.time_order(df).collect()} == {"a": 1, "b": 2, "c": 0}


def test_parse_number(spark):
    cells = ["1", " 2.5 ", '"3"', "", "NA", "n/a", "1,234.5", "9,78", "1,234", "abc", "5 m", "1 2", "-1e3", "2.0.", None, "+.5"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i long, c string")
    value, reason = parsing.parse_number(F.col("c"), True)
    got = {r.i: (r.v, r.r) for r in df.select("i", value.alias("v"), reason.alias("r")).collect()}
    want = [1, 2.5, 3, "empty_or_na", "empty_or_na", "empty_or_na", 1234.5, 9.78, 1234, "unrepairable", 5, "unrepairable", -1000, 2.0, "empty_or_na", 0.5]
    for i, w in enumerate(want):
        assert got[i] == ((None, w) if isinstance(w, str) else (w, None)), cells[i]
    plain, _ = parsing.parse_number(F.lit("9,78"))
    assert df.select(plain).first()[0] == 978


def test_label_tokens(spark):
    df = spark.createDataFrame([("1.0",), (" 2 ",), ('"idle"',), ("1d",), ("0.5",)], "c string")
    assert [r[0] for r in df.select(parsing.label_token(F.col("c"))).collect()] == ["1", "2", "idle", "1d", "0.5"]


def test_label_rules():
    assert labels.resolve(["0", "1", "3"], None) == ({"0": 0, "1": 1, "3": 2}, [("noncontiguous_labels", "0,1,3")])
    assert labels.resolve(["b", "a"], None)[0] == {"a": 0, "b": 1}
    mapping = {"idle": 0, "left": 1, "right": 2}
    assert labels.resolve(["idle", "1", "right"], mapping) == ({"1": 1, "idle": 0, "right": 2}, [("label_keyspace_mixed", "1,idle,right")])
    assert ("label_not_in_map", "up") in labels.resolve(["idle", "up"], mapping)[1]


def test_every_occurrence_of_a_cell_is_parsed(spark, tmp_path):
    spark.createDataFrame([(1, "a 5 5 x 5 7"), (2, "5 (521)")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.pos, r.token) for r in catalogue.QUERIES["parse_number"](spark, str(tmp_path)).collect())
    assert got == [(1, 1, "5"), (1, 2, "5"), (1, 4, "5"), (1, 5, "7"), (2, 0, "5"), (2, 1, "(521)")]
    made = catalogue.QUERIES["parse_census"](spark, str(tmp_path)).collect()
    assert sum(r.n for r in made) == 6 and sum(r.tokens for r in made) == 3


def numpy_q(x):
    m, s, d = x.mean(), x.std(), np.diff(x)
    return {
        "mean": m, "std": s, "rms": np.sqrt((x**2).mean()), "mad": np.abs(x - m).mean(), "mcr": (np.diff(np.sign(x - m)) != 0).sum() / len(x),
        "pscr": (np.diff((x > m + s).astype(int)) == 1).sum() / len(x), "crest": np.abs(x).max() / max(np.sqrt((x**2).mean()), 1.0), "rds": np.sqrt((d**2).mean()),
    }


def numpy_s(x):
    m, s, d, t = x.mean(), x.std(), np.diff(x), np.arange(len(x)) - (len(x) - 1) / 2
    sd = s if s > 1e-9 else 1
    out = {"kurtosis": (((x - m) / sd) ** 4).mean() - 3, "skewness": (((x - m) / sd) ** 3).mean(), "lr_slope": (t * x).sum() / (t**2).sum()}
    mob = np.sqrt(d.var() / x.var()) if x.var() > 1e-9 else 0
    out |= {"mobility": mob, "complexity": np.sqrt(np.diff(d).var() / d.var()) / mob if mob else 0, "autocorr": np.corrcoef(x[:-1], x[1:])[0, 1] if s > 1e-9 else 0}
    return out


def test_feature_banks(spark):
    rng = np.random.default_rng(1)
    windows = {0: rng.normal(size=30), 1: np.full(30, 2.0), 2: np.sin(np.arange(30) / 3) * 4}
    df = spark.createDataFrame([(w, k, float(v)) for w, x in windows.items() for k, v in enumerate(x)], "w long, k long, x double")
    for bank_of, want_of in ((bank.bank_q, numpy_q), (bank.bank_s, numpy_s)):
        for r in bank_of(df, ["w"]).collect():
            for name, v in want_of(windows[r.w]).items():
                assert math.isclose(r[name], v, rel_tol=1e-9, abs_tol=1e-9), (r.w, name)


def gesture(peaks, n, seed):
    z = np.random.default_rng(seed).normal(0, 0.01, n)
    for p in peaks:
        z[p - 1 : p + 2] += 6
    return z


def test_envelope_query_is_whole(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.label, r.pos): r.env for r in catalogue.QUERIES["envelope"](spark, sf).collect()}
    want = {}
    for label in range(4):
        x = np.array([r.x for r in catalogue._signal(spark, sf).filter(f"label = {label}").orderBy("pos").collect()])
        sw = np.lib.stride_tricks.sliding_window_view(x - x.mean(), 19)
        want |= {(label, i): e for i, e in enumerate(np.sqrt(sw.min(1) ** 2 + sw.max(1) ** 2))}
    assert max(p for _, p in got) >= 500
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def brute_centers(x, w):
    ww = max(1, int(w * 0.95))
    c = x - x.mean()
    sw = np.lib.stride_tricks.sliding_window_view(c, ww)
    env = np.sqrt(sw.min(1) ** 2 + sw.max(1) ** 2)
    thr, segs, on = 0.5 * env.mean(), [], None
    for i, v in enumerate(env, 1):
        if v > thr and on is None:
            on = i
        elif v <= thr and on is not None:
            segs.append((on + ww // 2, i + ww // 2))
            on = None
    if on is not None:
        segs.append((on + ww // 2, len(env) + ww // 2))
    cand = [(int(s + np.argmax(np.abs(c)[s:e])), np.abs(c)[s:e].max()) for s, e in ((s, min(e, len(c))) for s, e in segs) if e - s > 1]
    kept = []
    for p, _ in sorted(cand, key=lambda y: -y[1]):
        if all(abs(p - k) >= w for k in kept):
            kept.append(p)
    out = [k for k in kept if k - w // 2 >= 0 and k - w // 2 + w <= len(c) and abs(int(np.argmax(np.abs(c)[k - w // 2 : k - w // 2 + w])) - w // 2) <= 10]
    return sorted(kept), sorted(out)


@pytest.mark.parametrize(("n", "peaks", "w", "seed"), [(15000, [150 * k for k in range(1, 100)], 20, 11), (640, [30, 200, 400], 64, 3), (15, [7], 20, 2), (400, [100, 110, 300], 40, 5)])
def test_events_match_brute_force(spark, n, peaks, w, seed):
    x = gesture(peaks, n, seed)
    df = spark.createDataFrame([(0, i, n, float(v)) for i, v in enumerate(x)], "label long, pos long, n long, x double")
    _, centers, windows = events.detect(df, ["label"], w)
    want = brute_centers(x, w) if n > int(w * 0.95) else ([], [])
    assert sorted(r.center for r in centers.collect()) == want[0]
    assert sorted(r.center for r in windows.collect()) == want[1]
    if w == 20 and n > 100:
        assert len(want[1]) == 99


def test_antialias():
    t = np.arange(2000) / 200
    tone = np.sin(2 * np.pi * 70 * t)
    up, down = resample.ratio(200, 100)
    out = resample.resample_poly(tone, up, down)
    assert 20 * np.log10(tone[::2][100:-100].std() / out[100:-100].std()) >= 20
    level = 9.78 + np.sin(2 * np.pi * 10 * np.arange(1600) / 200)
    made = resample.resample_poly(level, up, down)
    assert np.abs(made - level[::2]).max() < 0.5
    assert len(made) == 800


def test_direction_and_guard():
    assert resample.direction(200, 100) == "down"
    assert resample.direction(100, 99) == "up_or_noop"
    assert resample.direction(float("nan"), 50) == "up_or_noop"
    assert resample.least_samples(*resample.ratio(200, 25)) == 483


def test_regrid(spark):
    df = spark.createDataFrame([(0, i / 50, float(i)) for i in range(50)], "s long, t double, x double")
    rows = sorted(resample.regrid(df, ["s"], 0.01, ["x"]).collect(), key=lambda r: r.step)
    assert len(rows) in (98, 99)
    assert all(math.isclose(r.x, r.step / 2, abs_tol=1e-6) for r in rows)


def test_combine_refuses_other_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "a long, b long"), spark.createDataFrame([(1, 2)], "b long, a long")
    with pytest.raises(resample.ColumnMismatch):
        resample.combine([a, b], "a")


def loop_consecutive(preds, n):
    out, cls, size, now = [], preds[0], 1, -1
    for p in preds:
        size = size + 1 if p == cls else 1
        cls = p
        now = cls if size >= n else now
        out.append(now)
    return out


def test_postprocessing_loops(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet(np.ones(4), 200)
    df = spark.createDataFrame([(0, i, row.tolist()) for i, row in enumerate(p)], "stream long, pos long, p array<double>")
    base = df.withColumn("pred", postprocess.argmax(F.col("p")))
    preds = p.argmax(1).tolist()
    for n in (2, 3, 5):
        got = [r.out for r in postprocess.consecutive(base, n).orderBy("pos").collect()]
        assert got == loop_consecutive(preds, n)
    e = p[0]
    want = [e]
    for row in p[1:]:
        e = 0.3 * row + 0.7 * e
        want.append(e)
    got = np.array([r.e for r in postprocess.ema(df).orderBy("pos").collect()])
    assert np.allclose(got, np.array(want))
    votes = [r.out for r in postprocess.majority(base, 5, 4).orderBy("pos").collect()]
    assert votes == [int(np.bincount(preds[max(0, i - 4) : i + 1]).argmax()) for i in range(200)]


def test_masks(spark):
    df = spark.createDataFrame([("static const uint64_t FEATURES_EXTRACTION_MASK[] = { 0xffffffff00000000, 0x0 };",)], "source string")
    rows = labels.decode_masks(df).collect()
    assert {r.axis for r in rows if r.enabled} == {0}
    assert len(rows) == 56
