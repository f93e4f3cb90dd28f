"""The queries opN_<name> over the driver's tables, each a thin layer over its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bag_minhash, byte_repeats, decontaminate, language_id, mixing, pii, secrets, token_output, weighted_fingerprints, word_windows
from tidemark.llm.common import documents
from tidemark.session import work_dir


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-store")
    token_output.write_store(documents(spark, sf_dir), path, tokenizer_path(), end_id=0)
    return token_output.read_store(spark, path)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op4_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.remove_repeats(documents(spark, sf_dir), window=50, with_text=False).drop("kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    said = language_id.identify(docs, language_id.train(docs))
    return said.select("doc_id", (language_id.fold() == 2).alias("held_out"), "lang_pred", "score")


def op6_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints.fingerprint(documents(spark, sf_dir))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(documents(spark, sf_dir))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), weights=[3, 1, 2], total_share=1.5, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.remove_repeats(documents(spark, sf_dir), window=35, with_text=False).drop("kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# The parts of operators that SQL can say.


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def personal_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_weighted_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_source_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def queries() -> dict:
    parts = [secret_base_spans, personal_base_spans, edited_texts, mixing_targets]
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()} | {f.__name__: f for f in parts}


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _spans_sql(kinds: list[tuple[str, str, str]], order: str) -> str:
    """Matches of each (kind, pattern, condition on the match m and its second group g) with places from the lengths between them."""
    made = " union all ".join(
        f"select doc_id, {i} as k, '{kind}' as kind, regexp_extract_all(s, '{p}') as ms, regexp_extract_all(s, '{p}', {2 if 'g' in need.split() else 0}) as gs, regexp_split_to_array(s, '{p}') as ps from t"
        for i, (kind, p, need) in enumerate(kinds)
    )
    need = " ".join(f"when {i} then {need}" for i, (_, _, need) in enumerate(kinds))
    count = ", ".join(f"count(*) filter (where k={i}) as n_{kind}" for i, (kind, _, _) in enumerate(kinds))
    return f"""with t as (select doc_id, coalesce(text,'') as s from documents), a as ({made}),
b as (select doc_id, k, kind, i, ms[i] as m, gs[i] as g, list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) as st from (select *, unnest(range(1, len(ms)+1)) as i from a)),
c as (select doc_id, k, kind, st::bigint as st, (st+length(m))::bigint as en from b where case k {need} end),
d as (select doc_id, {count}, string_agg(kind||':'||st||':'||en, ',' order by {order}) as said from c group by doc_id)
select t.doc_id, {", ".join(f"coalesce(n_{kind},0) as n_{kind}" for kind, _, _ in kinds)}, sha256(coalesce(said,'')) as base_sha256 from t left join d using(doc_id)"""


_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token", "api"))) + "_?" + _either("key")
SECRET_SQL = _spans_sql(
    [("assign", f"""({_NAMES})["\'\']?\\x20*[:=]\\x20*["\'\']?([A-Za-z0-9+/_.=-]+)""", "length( g ) >= 12"), ("access", "AKIA[A-Z0-9]+", "length(m) >= 18"), ("hex", "[0-9a-f]+", "length(m) >= 16")], "st, k"
)
_DIGITS = "length(regexp_replace(m, '[^0-9]', '', 'g'))"
_LUHN = "list_sum(list_transform(string_split(reverse(regexp_replace(m, '[^0-9]', '', 'g')), ''), lambda x, i: case when i%2=1 then x::int when x::int>4 then 2*x::int-9 else 2*x::int end)) % 10 = 0"
PERSONAL_SQL = _spans_sql(
    [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_bool_and(list_transform(string_split(m,'.'), lambda x: length(ltrim(x,'0'))<=3 and coalesce(try_cast(nullif(ltrim(x,'0'),'') as int),0)<=255))"),
        ("card", r"[0-9]([\x20-]?[0-9])+", f"{_DIGITS} between 13 and 19 and {_LUHN}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"{_DIGITS} between 9 and 15"),
    ],
    "k, st",
)

EDITED_SQL = """with t as (select doc_id, coalesce(text,'') as s from documents), n as (select *, coalesce(lead(s) over (order by doc_id desc), first_value(s) over (order by doc_id desc)) as nx from t)
select doc_id, length(s) as n_chars, sha256(substr(s, 1, length(s)-length(s)//2) || substr(nx, 1, length(s)//2)) as edited_sha256 from n"""

#: The clamped sources are those of least clamp by weight; the level of the rest follows from their sums.
TARGETS_SQL = r"""with t as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents), s as (select source, sum(size)::bigint as n from t group by source),
w as (select *, 2.0*n as cap, [2,3,1][(row_number() over (order by source nulls last))%3+1]::double as weight from s),
o as (select *, row_number() over (order by cap/weight, source nulls last) as k, sum(cap) over (order by cap/weight, source nulls last) as caps, sum(weight) over () - sum(weight) over (order by cap/weight, source nulls last) as rest, 1.5*sum(n) over () as total from w),
c as (select 0 as k, total/(sum(weight) over ()) as level from o union all select k, (total-caps)/rest from o where rest>1e-9),
l as (select c.level from c left join o on o.k=c.k+1 where o.k is not null and o.cap/o.weight>=c.level order by c.k limit 1)
select doc_id, t.size, n as source_size, round(least(cap, weight*coalesce((select level from l), 1e300)), 6) as target from t join w on t.source is not distinct from w.source"""

#: Strings as hex, two digits a byte; a byte goes if one of the 50 strings that cover it starts in a smaller document.
BYTE_REPEATS_SQL = """with t as (select doc_id, hex(encode(coalesce(text,''))) as h from documents),
b as (select doc_id, h, unnest(range(0, length(h)//2)) as i from t),
s as (select doc_id, i, substr(h, 2*i+1, 2) as c, length(h)//2 as n, case when 2*i+100<=length(h) then substr(h, 2*i+1, 100) end as w from b),
m as (select doc_id, i, c, coalesce(w is not null and min(doc_id) over (partition by w) < doc_id, false) as hit from s),
g as (select doc_id, i, c, bool_or(hit) over (partition by doc_id order by i rows between 49 preceding and current row) as gone from m),
e as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from g),
r as (select doc_id, count(*) as n_bytes, count(*) filter (where gone) as n_removed, count(*) filter (where opens) as n_spans, coalesce(string_agg(c, '' order by i) filter (where not gone), '') as kept from e group by doc_id)
select t.doc_id, coalesce(n_bytes,0) as n_bytes, coalesce(n_removed,0) as n_removed, coalesce(n_spans,0) as n_spans, sha256(unhex(coalesce(kept,''))) as kept_sha256 from t left join r using(doc_id)"""

WORD_WINDOWS_SQL = """with t as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as ws from documents),
p as (select doc_id, ws, unnest(range(1, len(ws)+1)) as j from t),
s as (select doc_id, j, ws[j] as c, case when j+34<=len(ws) then array_to_string(ws[j:j+34], ' ') end as w from p),
m as (select doc_id, j, c, w is not null and count(*) over (partition by w) > 1 as hit from s),
g as (select doc_id, j, c, bool_or(hit) over (partition by doc_id order by j rows between 34 preceding and current row) as gone from m),
r as (select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed, coalesce(string_agg(c, ' ' order by j) filter (where not gone), '') as kept from g group by doc_id)
select t.doc_id, coalesce(n_words,0) as n_words, coalesce(n_removed,0) as n_removed, sha256(coalesce(kept,'')) as kept_sha256 from t left join r using(doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_byte_repeats": BYTE_REPEATS_SQL, "op9_word_windows": WORD_WINDOWS_SQL, "secret_base_spans": SECRET_SQL, "personal_base_spans": PERSONAL_SQL,
        "edited_texts": EDITED_SQL, "mixing_targets": TARGETS_SQL,
    }
