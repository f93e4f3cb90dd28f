"""Benchmark decontamination by template canonicalisation; DataFrame and SQL functions only.

Texts are cut into lower-cased tokens. Numbers, units after a number, and capitalised words become the typed placeholders <num>, <unit>
and <name>, so a question asked again with other numbers or names has the same template. A capitalised word that opens a sentence, line
or text may be a name or not: the strict template keeps it, the loose one makes it a <name> too, and either may match.

Windows of ``window`` template tokens are hashed and the documents' windows hash-joined to those of the benchmark. A window with fewer
than ``literal`` tokens that aren't placeholders says too little as a template and is hashed with its very tokens instead (an exact
window), so number-heavy items are found where they are copied word for word. One that is short of literals only in the loose template
keeps its opening words there.

Windows of one alignment that cover tokens without a gap are a run. A run counts if its slots agree: every value of a slot in the item
stands for one value in the document, and the other way round. A document holds an item if ``coverage`` of the item's windows, or of
those of them that are templates, occur in runs that agree with each other, wherever they stand, so inserted or deleted words only cost
the windows that hold them. From each run as the first, others are added longest first while they agree; all verbatim runs together are
one more choice.

Items with fewer tokens than a window are matched by windows of their own length, down to ``least`` tokens. Shorter items can't be told
from chance inside a text; a document holds one if its tokens are the item's and nothing else. Items without any token never match.

The benchmark's windows are broadcast only if there are at most ``broadcast_rows`` of them (about 40 bytes each); beyond that the
join shuffles, after equal windows of a document have been merged.

Defined cases: null and empty texts hold nothing; a null item_id or item text is no item; an item_id with several texts is held if one
of them is; equal rows (same id and text) share their result and each is returned; with an empty benchmark every document is clean;
texts are read whole whatever their length; other columns are ignored, and ``clean`` keeps them whatever their names.
"""


from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, packed, unpacked

UNITS = "mm|cm|km|m|mg|g|kg|lb|lbs|oz|ml|l|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|mph|kmh|dollars?|euros?|cents?|percent|inch|inches|ft|feet|miles?|meters?|metres?|degrees?|°c|°f|%|\\$|€|£"
_NAME, _UNIT, _FIRST = "\u0002", "\u0003", "\u0004"
_BREAK = "[^\\p{L}\\p{N}\u0002\u0003\u0004%$€£°]+"
#: Low bits of a code: the kind of its token; the rest is the hash of the token itself.
_KIND, _OPENS, _NUM, _CALLED, _MEASURE = 7, 1, 2, 4, 6


def tokens(text: Column) -> Column:
    """Lower-cased tokens; names, units and other capitalised words carry a leading mark."""
    text = F.regexp_replace(text, "[\u0002\u0003\u0004]", " ")
    text = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "")
    text = F.regexp_replace(text, rf"(?i)(?<=\d)[\x20-]?({UNITS})(?![\p{{L}}\p{{N}}])", f" {_UNIT}$1")
    text = F.regexp_replace(text, r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;]\x20)(?=\p{Lu}\p{Ll})", _NAME)
    text = F.regexp_replace(text, r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{N}\u0002\u0003%$€£°])", _FIRST)
    return F.array_remove(F.split(F.lower(text), _BREAK), "")


def coded(t: Column) -> Column:
    """Code of a token: its hash with the kind in the low bits; 0 is a plain word."""
    first = F.ascii(t)  # most tokens start with a letter, so that is asked first
    kind = F.when(first > ord("9"), 0).when(first >= ord("0"), _NUM).when(first == ord(_NAME), _CALLED).when(first == ord(_UNIT), _MEASURE).when(first == ord(_FIRST), _OPENS).otherwise(0)
    plain = F.when(first > ord(_FIRST), t).otherwise(F.substring(t, 2, 1 << 30))
    return F.xxhash64(plain).bitwiseAND(F.lit(~_KIND)).bitwiseOR(kind.cast("long"))


def _kind(code: Column) -> Column:
    return code.bitwiseAND(F.lit(_KIND).cast("long"))


def _strict(code: Column) -> Column:
    """The token's place in the strict template: 2, 4 or 6 for a placeholder, else the hash of the word."""
    return F.when(_kind(code) >= _NUM, _kind(code)).otherwise(code.bitwiseAND(F.lit(~_KIND)))


def _loose(code: Column) -> Column:
    return F.when(_kind(code) == _OPENS, F.lit(_CALLED).cast("long")).otherwise(_strict(code))


def _placeholder(place: Column) -> Column:
    return place.between(1, _KIND)


def _rows(df: DataFrame, *keys: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = df.select(*keys, tokens(text).alias("raw"))
    plain = F.transform("raw", lambda t: F.translate(t, _NAME + _UNIT + _FIRST, ""))
    return made.select(*keys, plain.alias("raw"), F.transform("raw", coded).alias("code"))


def _windows(rows: DataFrame, sizes: list[int], literal: int, *keys: str) -> DataFrame:
    """One row a place: keys, pos, and strict_n, loose_n and exact_n for each size n, null where a window doesn't fit.

    exact tells that a window is short of literals and strict a hash of its very tokens; loose is null where that template is short of them.
    A text is gone through once for all sizes. Each step's columns are used more than once by the next, so they stay steps of their
    own and the generated code short enough to be compiled.
    """
    most = range(max(sizes, default=1))
    at = rows.filter(F.size("code") >= min(sizes, default=1)).select(*keys, "code", F.posexplode("code").alias("pos", "head"))
    at = at.select(*keys, "pos", (F.size("code") - F.col("pos")).alias("room"), F.col("head").alias("c0"), *[F.get("code", F.col("pos") + i).alias(f"c{i}") for i in most[1:]])
    at = at.select(*keys, "pos", "room", *[F.col(f"c{i}") for i in most], *[_strict(F.col(f"c{i}")).alias(f"s{i}") for i in most])
    at = at.select("*", *[F.when(_kind(F.col(f"c{i}")) == _OPENS, F.lit(_CALLED).cast("long")).otherwise(F.col(f"s{i}")).alias(f"l{i}") for i in most])
    # 1 for a placeholder, whose low bits aren't 0 as those of a word are.
    held = lambda c: F.shiftright(_kind(F.col(c)) + _KIND, 3)
    total = lambda name, n: reduce(lambda a, b: a + b, [held(f"{name}{i}") for i in range(n)])
    at = at.select("*", *[total(name, n).alias(f"{name}_{n}") for n in sizes for name in "sl"])
    out = []
    for n in sizes:
        fits, spare = F.col("room") >= n, n - min(literal, n)
        part = lambda name, n=n: [F.col(f"{name}{i}") for i in range(n)]
        very = F.xxhash64(*[c.bitwiseAND(F.lit(~_KIND)) for c in part("c")], F.lit(-n))
        strict = F.when(fits & (F.col(f"s_{n}") <= spare), F.xxhash64(*part("s"), F.lit(n))).when(fits, very)
        out += [strict.alias(f"strict_{n}"), F.when(fits & (F.col(f"l_{n}") <= spare), F.xxhash64(*part("l"), F.lit(n))).alias(f"loose_{n}"), F.when(fits, F.col(f"s_{n}") > spare).alias(f"exact_{n}")]
    return at.select(*keys, "pos", *out)


def _whole(rows: DataFrame, least: int, *keys: str) -> DataFrame:
    """Texts of 1 to ``least`` - 1 tokens with the hash of them all."""
    few = rows.filter(F.size("raw").between(1, least - 1))
    return few.select(*keys, F.xxhash64(F.concat_ws(" ", "raw")).alias("all"), F.col("raw"))


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.3, least: int = 5, literal: int = 4, broadcast_rows: int = 2_000_000
) -> DataFrame:
    """(doc_id, tie, item_id, share, renamed): the items each document holds, and whether slots have other values."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    docs = docs.select(doc_id, _tie().alias("tie"), "text")
    # An item is a text: an item_id may have several.
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    items = items.dropDuplicates().withColumn("item", F.struct("item_id", _tie().alias("variant")))
    items = materialise(_rows(items, "item"), "benchmark-tokens")
    tiny = _whole(items, least, "item")
    n = F.size("code")
    items = items.filter(n >= least).withColumn("own", F.least(n, F.lit(window)))
    sizes = sorted(r.size for r in items.select(F.col("own").alias("size")).distinct().collect())  # at most window values
    made = _windows(items, sizes, literal, "item", "own")
    own = lambda name: F.coalesce(*[F.when(F.col("own") == n, F.col(f"{name}_{n}")) for n in sizes], F.lit(None)).alias(name)
    made = made.select("item", F.col("pos").alias("item_pos"), own("exact").cast("boolean").alias("exact"), own("strict").cast("long").alias("strict"), own("loose").cast("long").alias("loose"))
    made = made.filter("strict is not null")
    made = made.withColumn("loose", F.coalesce("loose", "strict"))
    one = lambda h, a, b: F.struct(F.col(h).alias("item_hash"), F.lit(a).alias("in_strict"), F.lit(b).alias("in_loose"))
    both = F.when(F.col("loose") == F.col("strict"), F.array(one("loose", True, True))).otherwise(F.array(one("strict", True, False), one("loose", False, True)))
    wanted = materialise(made.select("item", "item_pos", "exact", F.explode(both).alias("w")).select("item", "item_pos", "exact", "w.*"), "benchmark-windows")
    exact_at = F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_pos")))).alias("exact_at")
    total = wanted.groupBy("item").agg(F.count_distinct("item_pos").alias("total"), exact_at).withColumn("templates", F.col("total") - F.size("exact_at"))
    count = wanted.count()
    rows = _rows(docs, "doc_id", "tie")
    # Windows without an opening word have one hash in both templates.
    hashes = [h for n in sizes for h in (F.col(f"strict_{n}"), F.when(F.col(f"loose_{n}") != F.col(f"strict_{n}"), F.col(f"loose_{n}")))] or [F.lit(None).cast("long")]
    found = _windows(rows, sizes, literal, "doc_id", "tie").select("doc_id", "tie", "pos", F.explode(F.array(*hashes)).alias("hash")).filter("hash is not null")
    if count <= broadcast_rows:
        hits = found.join(F.broadcast(wanted), F.col("hash") == F.col("item_hash"))
    else:
        hits = found.join(wanted.hint("shuffle_hash"), F.col("hash") == F.col("item_hash"))
    hit = F.struct((F.col("pos") - F.col("item_pos")).alias("shift"), F.col("item_pos").alias("at"), "in_strict", "in_loose")
    pairs = hits.groupBy("doc_id", "tie", "item").agg(F.collect_set(hit).alias("hits"))
    # Windows of all alignments together are the most that can agree.
    pairs = pairs.join(total.join(items.select("item", F.col("own").alias("size")), "item"), "item")
    fewest = F.when(F.col("templates") > 0, F.col("templates")).otherwise(F.col("total"))
    pairs = pairs.filter(F.size(F.array_distinct("hits.at")) >= F.greatest(F.lit(1.0), fewest * coverage))
    pairs = materialise(pairs, "decontaminate-pairs")
    held = pairs.select("doc_id", "tie").distinct()
    some = docs.join(held.withColumnsRenamed({"doc_id": "h_id", "tie": "h_tie"}), F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("tie") == F.col("h_tie")), "left_semi")
    raw = _rows(some.dropDuplicates(["doc_id", "tie"]), "doc_id", "tie").withColumnsRenamed({"doc_id": "d_id", "tie": "d_tie", "raw": "d_raw", "code": "d_code"})
    pairs = _runs(pairs).join(raw, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("tie") == F.col("d_tie")))
    pairs = pairs.join(items.select("item", "raw", "code"), "item")
    key = ["doc_id", "tie", "item", "total", "templates", "exact_at"]
    pairs = pairs.select(*key, F.array_distinct(F.filter(F.transform("runs", _slots), lambda r: _agree(r["slots"]))).alias("runs"))
    pairs = pairs.withColumn("runs", F.reverse(F.array_sort("runs")))
    # From each run on, and from those that are verbatim, the runs that agree are taken, longest first.
    best = F.array_max(F.transform(F.concat(*[_together(level) for level in (False, True)]), lambda x: _share(x, coverage)))
    pairs = pairs.select(F.col("item.item_id").alias("item_id"), "doc_id", "tie", best.alias("best")).filter("best.share > 0")
    whole = _whole(rows, least, "doc_id", "tie").withColumnRenamed("raw", "d_raw").join(tiny, "all").filter("raw = d_raw")
    whole = whole.select(F.col("item.item_id").alias("item_id"), "doc_id", "tie", F.struct(F.lit(1.0).alias("share"), F.lit(True).alias("same")).alias("best"))
    held = pairs.unionByName(whole).groupBy("doc_id", "tie", "item_id").agg(F.max("best").alias("best"))
    return held.select("doc_id", "tie", "item_id", F.col("best.share").alias("share"), (~F.col("best.same")).alias("renamed"))


def _tie() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _runs(pairs: DataFrame) -> DataFrame:
    """``hits`` as ``runs``: (loose, shift, begin, end, at), the windows of one alignment that join without a gap between tokens."""
    key = ["doc_id", "tie", "item", "total", "templates", "exact_at", "size"]
    rows = pairs.select(*key, F.explode("hits").alias("h")).select(*key, "h.*")
    rows = rows.select(*key, "shift", "at", F.explode(F.array_compact(F.array(F.when(F.col("in_strict"), F.lit(False)), F.when(F.col("in_loose"), F.lit(True))))).alias("is_loose"))
    order = Window.partitionBy(*key, "is_loose", "shift").orderBy("at")
    opens = F.when(F.col("at") - F.lag("at").over(order) <= F.col("size"), 0).otherwise(1)
    rows = rows.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    runs = rows.groupBy(*key, "is_loose", "shift", "run").agg(F.min("at").alias("begin"), (F.max("at") + F.col("size")).alias("end"), F.array_sort(F.collect_list("at")).alias("at"))
    return runs.groupBy(*key[:-1]).agg(F.collect_list(F.struct("is_loose", "shift", "begin", "end", "at")).alias("runs"))


def _slots(run: Column) -> Column:
    """A run as (n, at, is_loose, same, slots); slots are (kind, item's value, document's value) inside it."""

    def slot(i: Column) -> Column:
        code, there = F.get("code", i), F.get("d_code", run["shift"] + i)
        kind = F.when(run["is_loose"], _loose(code)).otherwise(_strict(code))
        return F.when(_placeholder(kind) & (_loose(there) == kind), F.struct(kind.alias("kind"), F.get("raw", i).alias("here"), F.get("d_raw", run["shift"] + i).alias("there")))

    made = F.transform(F.sequence(run["begin"], run["end"] - 1), slot)
    made = F.array_distinct(F.array_compact(made))
    return F.struct(F.size(run["at"]).alias("n"), run["at"].alias("at"), run["is_loose"].alias("is_loose"), _identical(made).alias("same"), made.alias("slots"))


def _agree(slots: Column) -> Column:
    """Whether each value of a side stands for one value of the other."""
    side = lambda name: F.size(F.array_distinct(F.transform(slots, lambda x: F.struct(x["kind"], x[name]))))
    return (side("here") == F.size(slots)) & (side("there") == F.size(slots))


def _identical(slots: Column) -> Column:
    return F.forall(slots, lambda x: x["here"] == x["there"])


def _together(is_loose: bool) -> Column:
    """Array of (at, same): windows that agree, for each run as the first and for all verbatim runs."""
    runs = F.filter("runs", lambda r: r["is_loose"] == is_loose)

    def add(now: Column, run: Column) -> Column:
        joined = F.transform(F.array(F.array_union(now["slots"], run["slots"])), lambda s: F.when(_agree(s), F.struct(F.array_union(now["at"], run["at"]).alias("at"), s.alias("slots"))))
        return F.coalesce(F.element_at(joined, 1), now)

    def said(sum_of: Column) -> Column:
        return F.struct(sum_of["at"].alias("at"), _identical(sum_of["slots"]).alias("same"))

    each = F.transform(runs, lambda first: F.aggregate(runs, F.struct(first["at"].alias("at"), first["slots"].alias("slots")), add, said))
    verbatim = F.array_distinct(F.flatten(F.transform(F.filter(runs, lambda r: r["same"]), lambda r: r["at"])))
    return F.concat(each, F.array(F.struct(verbatim.alias("at"), F.lit(True).alias("same"))))


def _share(taken: Column, coverage: float) -> Column:
    """(share, same) of windows that agree: of all windows of the item or of its templates, whichever is more; 0 below ``coverage``."""
    n = F.size(taken["at"])
    of = F.size(F.array_except(taken["at"], F.col("exact_at")))
    share = F.greatest(n / F.col("total"), F.when(F.col("templates") > 0, of / F.col("templates")).otherwise(F.lit(0.0)))
    return F.struct(F.when((n > 0) & (share >= coverage), share).otherwise(F.lit(0.0)).alias("share"), taken["same"].alias("same"))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row a document: (doc_id, contaminated, n_items, items, best_share, n_renamed); ``items`` lists item ids in order."""
    found = matches(docs, benchmark, **options)
    found = found.groupBy("doc_id", "tie").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("items"), F.max("share").alias("best_share"), F.sum(F.col("renamed").cast("long")).alias("n_renamed")
    ).withColumnsRenamed({"doc_id": "f_id", "tie": "f_tie"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie().alias("tie"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("tie") == F.col("f_tie")), "left")
    none = F.array().cast("array<long>")
    return out.select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items", none).alias("items"), F.round(F.coalesce("best_share", F.lit(0.0)), 6).alias("best_share"), F.coalesce("n_renamed", F.lit(0)).alias("n_renamed"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows are packed meanwhile, so no name of a column can clash."""
    found = matches(docs, benchmark, **options).select("doc_id", "tie").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie().alias("tie"), packed(docs).alias("row"))
    on = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["tie"] == found["tie"])
    return unpacked(rows.join(found, on, "left_anti"))
