"""The pipeline: each stage against brute force on what the stage before it kept."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
import tokenizers
import xxhash
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_operators import WORD, best_share, shingle_bag, template_tokens
from tidemark.llm import language_id, mixing
from tidemark.llm.queries import queries, tokenizer_path

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Names that a careless join, struct or star would trip over.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `__id` long, `__key` string, `__tie` long, `a.b` string, row long, copies int"


def corpus():
    rng = random.Random(4)
    vocab = {"aa": ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)], "bb": ["".join(rng.choice("mnopqrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]}
    say = lambda lang, k: " ".join(rng.choice(vocab[lang]) for _ in range(k))
    item = "the Baker sold 12 loaves to Alice and 7 to the miller who paid 3 dollars for each of them"
    rows = [(say(x, rng.randint(4, 120)), x) for x in ("aa", "bb") for _ in range(90)]
    rows += [(rows[k][0], rows[k][1]) for k in range(0, 90, 9)]
    for k in range(91, 180, 8):
        words = rows[k][0].split()
        if len(words) > 60:
            rows.append((" ".join([*words[:30], "changed", *words[31:]]), "bb"))
    rows += [(say("aa", 20) + " " + item + " " + say("aa", 20), "aa"), (say("bb", 30) + " " + item.replace("12", "40").replace("Alice", "Carol"), "bb")]
    rows += [("12 34 !!", "aa"), ("", None), (None, "bb"), ("....", None), (say("aa", 15000), "aa")]
    out = [(i, t, lang if i % 7 else None, rng.choice(["s1", "s2", "s2", "s3", None]), len(t or ""), 1, "k", 2, "x", 3, 4) for i, (t, lang) in enumerate(rows)]
    return [*out, (None, say("bb", 25), "bb", "s1", 1, 1, "k", 2, "x", 3, 4), out[5]], item


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Rows that each stage was given and gave."""
    rows, item = corpus()
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(0, item), (1, "3 + 4")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    now = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seen, names = {}, now.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, sf)
        if name != "token_output":
            assert out.columns == names
        path = f"{sf}/{name}.parquet"
        out.write.parquet(path)
        seen[name] = ([tuple(r) for r in now.collect()], [tuple(r) for r in spark.read.parquet(path).collect()])
        now = spark.read.parquet(path)
    return seen, item


def scores(model, text):
    """Softmax over classes, n-gram by n-gram."""
    bag = collections.Counter()
    code = [48 if 48 <= ord(c) <= 57 else ord(c) for c in f" {text.lower()} "]
    m32 = 0xFFFFFFFF
    for order in (1, 2, 3):
        for i in range(len(code) - order + 1):
            gram = 0
            for c in code[i : i + order]:
                gram = (gram * 0x9E3779B1 + (c + 1) * 0x85EBCA6B) & m32
            bag[(((gram ^ (gram >> 15)) * (0x2C1B3C6D + 2 * order)) & m32) >> 19] += 1
    x = {k: np.log1p(n) * model.idf[k] for k, n in bag.items()}
    norm = np.sqrt(sum(v * v for v in x.values()))
    z = (sum(v / norm * model.weights[k] for k, v in x.items()) + model.bias) / model.temperature
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def test_language_stage(spark, made):
    given, kept = made[0]["language_id"]
    model = language_id.train(spark.createDataFrame(given, SCHEMA))
    assert model.classes == ["aa", "bb"] and model.informed
    want = [r for r in given if r[1] and any(c.isalpha() for c in r[1]) and scores(model, r[1]).max() >= 0.6]
    assert sorted(map(str, kept)) == sorted(map(str, want)) and len(want) > 180
    for r in given[::9]:
        if r[1] and len(r[1]) < 2000:
            p = scores(model, r[1])
            (name,), (score,) = model.predict([r[1]])
            assert name in ("und", model.classes[int(p.argmax())]) and (name == "und" or abs(score - p.max()) < 1e-4)


def test_near_duplicate_stage(made):
    given, kept = made[0]["near_dedup"]
    texts = sorted({r[1] for r in given})
    bags, up = {t: shingle_bag(t) for t in texts}, {t: t for t in texts}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        both = sum((bags[a] & bags[b]).values())
        if both and both / (sum(bags[a].values()) + sum(bags[b].values()) - both) >= 0.8:
            up[root(a)] = root(b)
    least = {}
    for r in given:
        k, d = root(r[1]), -1 if r[0] is None else r[0]
        least[k] = min(least.get(k, d), d)
    assert sorted(-1 if r[0] is None else r[0] for r in kept) == sorted(least.values())
    assert len(kept) < len(given) - 12 and set(kept) <= set(given)


def test_decontamination_stage(made):
    given, kept = made[0]["decontaminate"]
    item = template_tokens(made[1])
    want = [r for r in given if best_share(item, template_tokens(r[1])) == 0]
    assert sorted(map(str, kept)) == sorted(map(str, want)) and len(want) == len(given) - 2


def rank_of(doc_id, text, seed=8):
    """The mixing order of a row, by the standard 64-bit hash."""
    tie = xxhash.xxh64_intdigest((text or "").encode(), 42) if text is not None else 42
    now = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42) if doc_id is not None else 42
    now = xxhash.xxh64_intdigest(tie.to_bytes(8, "little"), now)
    now = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), now)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(now) % 4096, signed(now), -1 if doc_id is None else doc_id, signed(tie)


def mix_by_hand(rows, partial, share=1.5, most=2):
    """(row, taken, epochs) of rows (doc_id, text, source, ...) given as (doc_id, text, source)."""
    size = lambda t: len(WORD.findall(t or ""))
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += size(t)
    target = mixing.water_fill(list(total.items()), [3, 1, 2], share * sum(total.values()), most)
    out = []
    for s, n in total.items():
        goal = round(target[s])
        whole = min(goal // n, most) if n else 0
        left = goal - whole * n
        groups = collections.defaultdict(list)
        for r in rows:
            if r[2] == s:
                groups[rank_of(r[0], r[1])].append(r)
        prior = 0
        for key in sorted(groups):
            g, k = groups[key], size(groups[key][0][1])
            given = k if prior + k * len(g) <= left else max(0, left - prior) // len(g)
            given = given if partial or given == k else (k if k and 2 * given >= k and prior <= left and given else 0)
            out += [(r, whole * k + given, whole + (given > 0)) for r in g]
            prior += k * len(g)
    return out


def test_mixing_stage(made):
    given, mixed = made[0]["mix"]
    want = collections.Counter()
    for r, _, epochs in mix_by_hand([(r[0], r[1], r[3]) for r in given], partial=False):
        want[r[0]] += epochs
    assert collections.Counter(r[0] for r in mixed) == +want
    assert set(mixed) <= set(given)


def test_mixing_query_equals_brute_force(spark, docs, rows):
    mine = [(r[0], r[1], r[3]) for r in rows]
    for partial in (True, False):
        got = collections.Counter((r.doc_id, r.taken, r.epochs) for r in mixing.mix(docs, partial=partial).collect())
        assert got == collections.Counter((r[0], t, e) for r, t, e in mix_by_hand(mine, partial))


def test_token_stage(made):
    given, index = made[0]["token_output"]
    lib = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for r in given:
        x = lib.encode(r[1], add_special_tokens=False).ids + [0]
        want[r[0], len(x), zlib.crc32(np.array(x, "<u4").tobytes())] += 1
    assert collections.Counter((r[0], r[2], r[3]) for r in index) == want
    at = 0
    for r in sorted(index, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]


def test_nothing_goes_for_want_of_labels(spark):
    rows, _ = corpus()
    letters = sum(bool(r[1]) and any(c.isalpha() for c in r[1]) for r in rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert STAGES["language_id"](spark, df.withColumn("lang", F.lit(None).cast("string")), SF).count() == letters
    rng = random.Random(1)
    wild = spark.createDataFrame([(*r[:2], rng.choice("xyz"), *r[3:]) for r in rows], SCHEMA)
    assert STAGES["language_id"](spark, wild, SF).count() == letters


def test_run_and_empty(spark, empty):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert {"pipeline", *queries()} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")} == set(range(1, 11))
