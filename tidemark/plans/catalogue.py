"""Registered queries over the driver's tables, and the same in DuckDB's SQL.

Adapters turn the tables into recordings: EV is ``events`` by user, LI is ``lineitem`` by supplier with a derived label of long runs, EM has one
window of 64 samples a vector, PR has one probability array a frame, DT has one row a token of documents that holds digits.
Doubles are rounded to six places and integers widened on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import features as bank
from tidemark.functions import parsing
from tidemark.operators import compare, events, labels, postprocess, resample
from tidemark.operators import sequence as seq

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

EM_W = 64
CLASSES = 8


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def seconds(c) -> F.Column:
    return F.unix_micros(c.cast("timestamp")) / 1e6


def ev(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "user_id", F.col("event_type").alias("label"), "value", seconds(F.col("ts")).alias("t"))
    return seq.ordinal(df, F.col("user_id"), ["event_id"]).drop("user_id")


LI_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
SENSORS = ["quantity", "extendedprice", "discount", "tax"]


def li(spark: SparkSession, sf: str) -> DataFrame:
    cols = [F.col(f"l_{c}").alias(c) for c in SENSORS]
    df = table(spark, sf, "lineitem").select("l_suppkey", *LI_ORDER, F.col("l_returnflag").alias("flag"), *cols)
    df = seq.ordinal(df, F.col("l_suppkey"), LI_ORDER).drop("l_suppkey", *LI_ORDER)
    return df.withColumn("label", (F.floor(F.col("pos") / 60) % 4).cast("long"))


def em(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), F.posexplode("embedding").alias("k", "x"))
    return df.withColumn("x", F.col("x").cast("double"))


def pr(spark: SparkSession, sf: str) -> DataFrame:
    first = F.transform(F.slice("embedding", 1, CLASSES), lambda x: F.abs(x.cast("double")))
    total = F.aggregate(first, F.lit(0.0), lambda a, x: a + x)
    return table(spark, sf, "embeddings").select(F.lit(0).cast("long").alias("stream"), F.col("vec_id").alias("pos"), F.transform(first, lambda x: x / total).alias("p"))


def dt(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("pos", "token"))
    return df.filter(F.col("token").rlike("[0-9]"))


EV = """ev as (select event_id, user_id as session, event_type as label, value, epoch(ts) as t,
 row_number() over (partition by user_id order by event_id)-1 as pos, count(*) over (partition by user_id) as n from events)"""
LI = """li as (select *, (pos//60)%4 as label from (select l_suppkey as session, l_returnflag as flag, l_quantity as quantity, l_extendedprice as extendedprice,
 l_discount as discount, l_tax as tax, row_number() over (partition by l_suppkey order by l_shipdate,l_orderkey,l_linenumber,l_partkey)-1 as pos,
 count(*) over (partition by l_suppkey) as n from lineitem))"""
EM = """em as (select vec_id, label::bigint as label, generate_subscripts(embedding,1)-1 as k, unnest(embedding)::double as x from embeddings)"""
PR = """pr0 as (select vec_id as pos, list_transform(embedding[1:8], lambda e: abs(e::double)) as a from embeddings),
pr as (select pos, list_transform(a, lambda e: e/(a[1]+a[2]+a[3]+a[4]+a[5]+a[6]+a[7]+a[8])) as p from pr0)"""
DT = r"""dt as (select doc_id, pos, token from (select doc_id, generate_subscripts(a,1)-1 as pos, unnest(a) as token from (select doc_id, regexp_split_to_array(text,'\s+') as a from documents)) where regexp_matches(token,'[0-9]'))"""


def runs_sql(src: str, label: str = "label") -> str:
    return f"""ch as (select *, case when pos>0 and lag({label}) over (partition by session order by pos) is not distinct from {label} then 0 else 1 end as c from {src}),
rid as (select *, sum(c) over (partition by session order by pos) as run_id from ch),
rn as (select *, min(pos) over (partition by session, run_id) as run_start, max(pos) over (partition by session, run_id)+1 as run_end from rid),
rt as (select session, run_id, {label} as label, count(*) as len from rid group by all)"""


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to some places without negative zero, integers to long."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), places) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(sql: str | None = None, places: int = 6):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf: tidy(f(spark, sf), places)
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def R(x: str, places: int = 6) -> str:
    return f"round({x},{places})+0.0"


# Runs and grid windows


@query(f"with {EV}, {runs_sql('ev')} select label, max(len) as max_run, sum(len)::bigint as total, count(*) as n_runs from rt group by label")
def run_lengths(spark, sf):
    return seq.run_lengths(ev(spark, sf))


@query(f"with {EV}, {runs_sql('ev')} select session, label, sum(len)::bigint as rows, count(*) as n_runs, max(len) as max_run, floor(quantile_cont(len,0.95))::bigint as p95_run from rt group by all")
def run_stats_p95(spark, sf):
    return seq.run_stats(ev(spark, sf))


def _pure_sql(src: str, runs: str, w: int, s: int) -> str:
    return f"""with {src}, {runs}, g as (select *, run_end-pos>={w} as pure from rn where pos%{s}=0 and pos+{w}<=n),
tot as (select count(*) as total_windows, coalesce(sum((not pure)::int),0)::bigint as mixed_windows from g),
ls as (select distinct label from rn), pw as (select label, count(*) as c from g where pure group by label)
select ls.label, coalesce(c,0) as pure_windows, total_windows, mixed_windows from ls left join pw using(label) cross join tot"""


@query(_pure_sql(EV, runs_sql("ev"), 3, 2))
def pure_windows(spark, sf):
    return seq.pure_windows(ev(spark, sf), 3, 2)


@query(_pure_sql(LI, runs_sql("li"), 50, 25))
def pure_windows_long(spark, sf):
    return seq.pure_windows(li(spark, sf), 50, 25)


@query(
    f"""with {EV}, {runs_sql('ev')}, cfg(w,s) as (values (3,2),(4,4),(2,1)), g as (select w, s, run_end-pos>=w as pure from rn cross join cfg where pos%s=0 and pos+w<=n)
select w::bigint as "window", s::bigint as shift, count(*) as total_windows, sum(pure::int)::bigint as pure_windows, sum((not pure)::int)::bigint as mixed_windows from g group by all"""
)
def pure_windows_multi_config(spark, sf):
    return seq.pure_windows_multi(ev(spark, sf), [(3, 2), (4, 4), (2, 1)])


@query(
    f"""with {LI}, {runs_sql('li')}, g as (select label from rn where pos%50=0 and pos+50<=n and run_end-pos>=50), c as (select label, count(*) as windows from g group by label),
a as (select (select distinct 1), max(windows)/min(windows) as ratio from c where windows>0), ls as (select distinct label from rn)
select ls.label, coalesce(windows,0) as windows, {R('ratio')} as ratio, ratio>=3 as imbalanced from ls left join c using(label) cross join a"""
)
def window_yield(spark, sf):
    return seq.window_yield(li(spark, sf), 50)


@query(f"with {EV}, {runs_sql('ev')} select label, max(len) as max_run from rt group by label having max(len)<6")
def class_run_below_window(spark, sf):
    return seq.class_run_below(ev(spark, sf), 6)


@query(f"with {LI} select session, count(*) as rows from li group by session having count(*)<600")
def session_below_window(spark, sf):
    return seq.session_below(li(spark, sf), 600)


# Order, rates, gaps


@query(
    f"""with {EV}, a as (select session, pos, case when event_id%97=0 then t-100000 else t end as t from ev), d as (select session, t-lag(t) over (partition by session order by pos) as d from a),
m as (select session, median(d) filter (where d>0) as m from d group by session)
select session, sum(coalesce(case when m is null then d<0 else d < -m end,false)::int)::bigint as bad_steps from d join m using(session) group by session"""
)
def time_order(spark, sf):
    df = ev(spark, sf).withColumn("t", F.when(F.col("event_id") % 97 == 0, F.col("t") - 100000).otherwise(F.col("t")))
    return seq.time_order(df)


@query(
    f"""with {EV}, d as (select session, t-lag(t) over (partition by session order by t) as d from ev), m as (select session, median(d) as m, count(*) as c from d group by session)
select session, {R('86400/m')} as hz from m where c>2 and m>0"""
)
def sampling_rate(spark, sf):
    return seq.sampling_rate(ev(spark, sf), unit=86400.0)


@query(
    f"""with {EV}, d as (select session, t-lag(t) over (partition by session order by pos) as d from ev), m as (select session, median(d) filter (where d>0) as m from d group by session)
select session, {R('86400/m')} as hz from m where m>0"""
)
def sampling_rate_row_order(spark, sf):
    return seq.sampling_rate(ev(spark, sf), unit=86400.0, in_row_order=True)


@query(
    f"""with {EV}, d as (select session, t-lag(t) over (partition by session order by t) as d from ev), m as (select session, median(d) as m, count(*) as c from d group by session),
r as (select 86400/m as hz from m where c>2 and m>0)
select count(*) as sessions, {R('min(hz)')} as min_hz, {R('max(hz)')} as max_hz, count(*)>=2 and (max(hz)-min(hz))/min(hz)>0.05 as mixed from r"""
)
def mixed_rate(spark, sf):
    return seq.mixed_rate(seq.sampling_rate(ev(spark, sf), unit=86400.0))


@query(
    f"""with {EV}, c as (select session, pos, t, n, (pos//12)%3 as label from ev), {runs_sql('c')}, d as (select session, run_id, label, lead(t) over (partition by session, run_id order by pos)-t as d from rn)
select session, run_id::bigint as run_id, label, count(*) as rows, {R('median(d)')} as median_step, {R('max(d)')} as max_step, coalesce(max(d)>4*median(d),false) as gap,
count(*)>=2 and not coalesce(bool_or(d<=0),false) as monotonic from d group by session, run_id, label"""
)
def gap_detect(spark, sf):
    df = ev(spark, sf).withColumn("label", (F.floor(F.col("pos") / 12) % 3).cast("long"))
    return seq.run_steps(df)


@query(
    """with a as (select event_id, user_id, event_id+5 as shifted, row_number() over (order by event_id)-1 as pos from events),
s as (select *, event_id-lag(event_id) over (order by pos) as d1, user_id-lag(user_id) over (order by pos) as d2, shifted-lag(shifted) over (order by pos) as d3 from a)
select 0::bigint as session, 'event_id' as name, bool_and(event_id=pos) as is_index, count(*)>2 and coalesce(bool_and(d1=1),false) as is_counter from s
union all select 0, 'user_id', bool_and(user_id=pos), count(*)>2 and coalesce(bool_and(d2=1),false) from s
union all select 0, 'shifted', bool_and(shifted=pos), count(*)>2 and coalesce(bool_and(d3=1),false) from s"""
)
def index_column(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", (F.col("event_id") + 5).alias("shifted"))
    return seq.index_columns(seq.ordinal(df, F.lit(0).cast("long"), ["event_id"]), ["event_id", "user_id", "shifted"])


@query(f"with {LI} select session, pos, n, quantity from li where n<=5 or (pos>=3 and pos<n-2)")
def edge_trim(spark, sf):
    return seq.edge_trim(li(spark, sf), 3, 2).select("session", "pos", "n", "quantity")


CP = "cp as (select *, row_number() over (partition by {0} order by session,pos)-1 as class_pos, count(*) over (partition by {0}) as class_n from {1})"


@query(f"with {LI}, {CP.format('label', 'li')} select label, count(*) as rows, max(class_pos) as last_pos, {R('sum(quantity)')} as quantity from cp where class_pos<(class_n//50)*50 group by label")
def trim_to_window_multiple(spark, sf):
    kept = seq.trim_to_multiple(li(spark, sf), 50)
    return kept.groupBy("label").agg(F.count("*").alias("rows"), F.max("class_pos").alias("last_pos"), F.sum("quantity").alias("quantity"))


@query(f"with {LI}, {CP.format('label', 'li')} select label, class_pos//50 as win, count(*) as rows, {R('avg(quantity)')} as mean from cp where (class_pos//50+1)*50<=class_n group by label, win")
def nonoverlap_windows(spark, sf):
    made = seq.nonoverlapping(seq.class_position(li(spark, sf)), 50)
    return made.groupBy("label", "win").agg(F.count("*").alias("rows"), F.avg("quantity").alias("mean"))


@query(
    f"""with {LI}, {CP.format('label', 'li')}, w as (select label, unnest(range((greatest(0,class_pos-50+25)//25)::bigint, (least(class_pos//25,(class_n-50)//25)+1)::bigint)) as win, quantity from cp where class_n>=50)
select label, win, count(*) as rows, {R('avg(quantity)')} as mean from w group by label, win"""
)
def sliding_windows(spark, sf):
    made = seq.sliding(seq.class_position(li(spark, sf)), 50, 25)
    return made.groupBy("label", "win").agg(F.count("*").alias("rows"), F.avg("quantity").alias("mean"))


@query(
    f"""with {LI}, c as (select count(*) as c from li group by session) select min(c) as min, floor(quantile_cont(c,0.25))::bigint as p25, floor(quantile_cont(c,0.5))::bigint as median,
floor(quantile_cont(c,0.75))::bigint as p75, max(c) as max, sum(c)::bigint as total from c"""
)
def session_length_stats(spark, sf):
    return seq.session_length_stats(li(spark, sf))


EVENT_TYPES = ["click", "error", "login", "purchase", "view"]


@query("select user_id as session, " + ", ".join(f"count(*) filter (where event_type='{v}') as n_{v}" for v in EVENT_TYPES) + " from events group by user_id")
def session_crosstab(spark, sf):
    return seq.crosstab(ev(spark, sf), EVENT_TYPES)


# Counts and rules


@query("select event_type as label, count(*) as n from events group by event_type")
def class_counts(spark, sf):
    return labels.counts(ev(spark, sf))


@query("with c as (select quality as v, count(*) as n from labels group by 1) select min(n) as min_n, max(n) as max_n, " + R("max(n)/min(n)") + " as ratio, max(n)/min(n)>=3 as imbalanced from c")
def imbalance(spark, sf):
    return labels.imbalance(table(spark, sf, "labels"), "quality")


@query("select toxic::bigint as label, count(*) as n from labels group by 1 having count(*)<20")
def small_classes(spark, sf):
    return labels.small(table(spark, sf, "labels"), "toxic", 20)


@query(
    f"""with {LI}, c as (select distinct label from li), e as (select distinct label*2 as label from li)
select 'derived' as name, min(label)=0 and max(label)=count(*)-1 as contiguous, count(*) as classes from c union all select 'gaps', min(label)=0 and max(label)=count(*)-1, count(*) from e"""
)
def label_contiguity(spark, sf):
    df = li(spark, sf)
    return labels.contiguity(df, "label", "derived").union(labels.contiguity(df.withColumn("label", F.col("label") * 2), "label", "gaps"))


@query("select l_suppkey%4 as source, l_returnflag as label, count(*) as rows from lineitem group by all")
def source_profile(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.groupBy((F.col("l_suppkey") % 4).alias("source"), F.col("l_returnflag").alias("label")).agg(F.count("*").alias("rows"))


@query(
    """with a as (select min(least(l_quantity,l_extendedprice,l_discount,l_tax)) as low, max(greatest(l_quantity,l_extendedprice,l_discount,l_tax)) as high, bool_and(l_quantity=floor(l_quantity)) as w1,
bool_and(l_extendedprice=floor(l_extendedprice)) as w2, bool_and(l_discount=floor(l_discount)) as w3, bool_and(l_tax=floor(l_tax)) as w4 from lineitem),
b as (select *, case when not w1 then 'quantity' when not w2 then 'extendedprice' when not w3 then 'discount' when not w4 then 'tax' end as f from a)
select round(low,6)+0.0 as low, round(high,6)+0.0 as high, f as first_fractional, case when f is not null then 'FLOAT32' when low>=-128 and high<=127 then 'INT8' when low>=-32768 and high<=32767 then 'INT16' else 'FLOAT32' end as dtype from b"""
)
def dtype_recommend(spark, sf):
    return compare.storage_type(li(spark, sf), SENSORS)


_CONTENT = """with a as (select 'quantity' as name, l_quantity as v from lineitem union all select 'extendedprice', l_extendedprice from lineitem union all select 'linenumber', l_linenumber::double from lineitem
union all select 'orderkey', l_orderkey::double from lineitem), b as (select name, max(abs(v)) as high, bool_and(v=floor(v)) as integral from a group by name)
select name, integral, case when not integral then 'float32' when high<=127 then 'int8' when high<=32767 then 'int16' else 'int32' end as dtype from b"""


@query(_CONTENT)
def dtype_content(spark, sf):
    df = table(spark, sf, "lineitem").select(*[F.col(f"l_{c}").alias(c) for c in ("quantity", "extendedprice", "linenumber", "orderkey")])
    return compare.content_type(df, df.columns)


@query(f"with c as ({_CONTENT}) select name, integral from c")
def integral_columns(spark, sf):
    return dtype_content(spark, sf).select("name", "integral")


# Cells and labels

_STRIP = r"regexp_replace(regexp_replace(regexp_replace({0},'^\s+|\s+$','','g'),'^\x22+|\x22+$','','g'),'^\s+|\s+$','','g')"
_NUM = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


def _parse_sql(comma: bool) -> str:
    decimal = "when c and not d and len(string_split(s,','))=2 and length(string_split(s,',')[2])<>3 then replace(s,',','.') " if comma else ""
    return f"""with {DT}, a as (select doc_id, pos, token, {_STRIP.format('token')} as s from dt), b as (select *, contains(s,',') as c, contains(s,'.') as d from a),
e as (select *, case {decimal}when c then replace(s,',','') else s end as f from b),
g as (select *, regexp_extract(f,'{_NUM}') as m, regexp_replace(f,'{_NUM}','') as rest, upper(s) in ('','NA','NAN','N/A','NULL','NONE','#N/A','#NA','NIL') as miss from e),
h as (select doc_id, pos, token, case when miss then 'empty_or_na' when m='' or regexp_matches(rest,'[0-9]') then 'unrepairable' end as reason, m from g)"""


@query(_parse_sql(False) + f" select doc_id, pos, token, {R('case when reason is null then try_cast(m as double) end')} as value, reason from h")
def parse_number(spark, sf):
    value, reason = parsing.parse_number(F.col("token"))
    return dt(spark, sf).select("doc_id", "pos", "token", value.alias("value"), reason.alias("reason"))


@query(_parse_sql(True) + " select coalesce(reason,'ok') as outcome, count(*) as n, count(distinct token) as tokens from h group by 1")
def parse_census(spark, sf):
    _, reason = parsing.parse_number(F.col("token"), True)
    made = dt(spark, sf).select("token", F.coalesce(reason, F.lit("ok")).alias("outcome"))
    return made.groupBy("outcome").agg(F.count("*").alias("n"), F.count_distinct("token").alias("tokens"))


@query("with t as (select distinct event_type as token from events), d as (select token, row_number() over (order by token)-1 as idx from t) select e.event_id, e.event_type as token, d.idx from events e join d on e.event_type=d.token")
def label_encode_sorted(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.col("event_type").alias("token"))
    return labels.encode(df, "token", labels.sorted_dictionary(df, "token"))


_MAP = {"click": 0, "view": 1, "login": 2, "logout": 3}
_MAP_SQL = "m(token,idx) as (values " + ",".join(f"('{k}',{v}::bigint)" for k, v in _MAP.items()) + ")"


@query(f"with {_MAP_SQL} select e.event_id, e.event_type as token, m.idx from events e join m on e.event_type=m.token")
def label_encode_map(spark, sf):
    df = table(spark, sf, "events").select("event_id", F.col("event_type").alias("token"))
    return labels.encode(df, "token", labels.dictionary(spark, _MAP)).filter("idx is not null")


@query(f"with {_MAP_SQL}, t as (select distinct event_type as token from events) select token, 'label_not_in_map' as code from t where token not in (select token from m) union all select token, 'mapped_class_absent' from m where token not in (select token from t)")
def label_unknown_anti(spark, sf):
    return labels.mismatch(table(spark, sf, "events"), "event_type", labels.dictionary(spark, _MAP))


@query(
    """with a as (select 0 as part, event_id, value from events where event_id%2=0 union all select 1, event_id, value from events where event_id%2=1)
select row_number() over (order by part, event_id)-1 as pos, part::bigint as part, event_id, round(value,6)+0.0 as value from a"""
)
def combine_union(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return resample.combine([df.filter("event_id % 2 = 0"), df.filter("event_id % 2 = 1")], "event_id")


# Features and comparisons

_PREP = f"""{EM}, f00 as (select *, round(avg(x) over w,12) as m, stddev_pop(x) over w as s, lag(x) over o as p from em window w as (partition by vec_id), o as (partition by vec_id order by k)),
f1 as (select *, x-p as d, round(m+s,12) as ms from f00), f as (select *, d-lag(d) over (partition by vec_id order by k) as dd, (x-m)/(case when s>1e-9 then s else 1 end) as z from f1)"""
_SHARED = {
    "min": "min(x)", "max": "max(x)", "range": "max(x)-min(x)", "mean": "avg(x)", "rms": "sqrt(avg(x*x))", "absmean": "avg(abs(x))", "mad": "avg(abs(x-m))",
    "zcr": "sum(case when sign(x)<>sign(p) then 1.0 else 0 end)::double/count(x)", "mcr": "sum(case when sign(x-m)<>sign(p-m) then 1.0 else 0 end)::double/count(x)",
    "rds": "coalesce(sqrt(avg(d*d)),0)", "amdif": "coalesce(avg(abs(d)),0)", "std": "stddev_pop(x)",
}
_QSQL = _SHARED | {
    "pzero": "avg((x>0)::int)", "pmean": "avg((x>m)::int)", "psigma": "avg((x>ms)::int)", "pscr": "sum(case when x>ms and p<=ms then 1.0 else 0 end)::double/count(x)",
    "crest": "max(abs(x))/greatest(sqrt(avg(x*x)),1.0)",
}
_SLOPE = "coalesce((avg(k*x)-avg(k)*avg(x))/nullif(avg(k*k)-avg(k)*avg(k),0),0)"
_MOB = "(case when var_pop(x)>1e-9 then sqrt(var_pop(d)/var_pop(x)) else 0 end)"
_SSQL = _SHARED | {
    "kurtosis": "avg(z*z*z*z)-3", "skewness": "avg(z*z*z)", "lr_slope": _SLOPE, "lr_intercept": f"avg(x)-{_SLOPE}*avg(k)", "psom": "avg((x>m)::int)", "psoz": "avg((x>0)::int)",
    "crest": "case when sqrt(avg(x*x))>1e-9 then max(abs(x))/sqrt(avg(x*x)) else 0 end", "mobility": _MOB,
    "complexity": f"case when {_MOB}>1e-9 then (case when var_pop(d)>1e-9 then sqrt(var_pop(dd)/var_pop(d)) else 0 end)/{_MOB} else 0 end",
    "autocorr": "case when max(s)>1e-9 and count(x)>2 then coalesce((sum(x*p)/count(p)-avg(x) filter (where p is not null)*avg(p))/nullif(stddev_pop(x) filter (where p is not null)*stddev_pop(p),0),0) else 0 end",
}


def _bank_sql(names: list[str], sql: dict[str, str], raw: bool = False) -> str:
    return "select vec_id, label, " + ", ".join(f"{sql[c] if raw else R(sql[c])} as \"{c}\"" for c in names) + " from f group by vec_id, label"


@query(f"with {_PREP} {_bank_sql(bank.Q, _QSQL)}")
def features_q(spark, sf):
    return bank.bank_q(em(spark, sf), ["vec_id", "label"])


@query(f"with {_PREP} {_bank_sql(bank.S, _SSQL)}")
def features_s(spark, sf):
    return bank.bank_s(em(spark, sf), ["vec_id", "label"])


def s_long(spark, sf) -> DataFrame:
    return bank.long_form(bank.bank_s(em(spark, sf), ["vec_id", "label"]), ["vec_id", "label"], bank.S)


_LONG = (
    f"{_PREP}, wide as ({_bank_sql(bank.S, _SSQL, True)}), lg as ("
    + " union all ".join(f'select vec_id, label, {i}::bigint as idx, \'{c}\' as feature, "{c}"::double as value from wide' for i, c in enumerate(bank.S))
    + "), mo as (select label, idx, feature, count(*) as n, avg(value) as mean, var_pop(value) as var, stddev_pop(value) as std from lg group by all)"
)
_ENOUGH = f"{_LONG}, me as (select * from mo where n>=3)"
_ANOVA = f"""{_ENOUGH}, gm as (select idx, sum(n*mean)/sum(n) as gm, sum(n) as total, count(*) as k, sum(n*var) as ssw from me group by idx),
an as (select me.idx, feature, sum(n*(mean-gm)**2)/greatest(any_value(k)-1,1)/(greatest(any_value(ssw)/greatest(any_value(total)-any_value(k),1),1e-6*(any_value(ssw)+sum(n*(mean-gm)**2))/any_value(total))+1e-9) as f
from me join gm using(idx) group by me.idx, feature)"""
_PAIRS = f"{_LONG}, pr_ as (select a.label as class_a, b.label as class_b, a.idx, a.feature, (a.mean-b.mean)/sqrt((a.var+b.var)/2+1e-9) as d from mo a join mo b on a.idx=b.idx and a.label<b.label)"


@query(f"with {_LONG} select label, idx, feature, n, {R('mean', 9)} as mean, {R('var', 9)} as var, {R('std', 9)} as std from mo", places=9)
def feature_moments(spark, sf):
    return compare.moments(s_long(spark, sf), ["label"])


@query(f"with {_PAIRS} select class_a, class_b, idx, feature, {R('d')} as d from pr_")
def cohens_d_pairs(spark, sf):
    return compare.class_pairs(compare.moments(s_long(spark, sf), ["label"]), "label")


@query(f"with {_ANOVA} select idx, feature, {R('f')} as f from an")
def anova_f(spark, sf):
    return compare.anova(s_long(spark, sf), "label")


@query(f"with {_ANOVA} select idx, feature, {R('f')} as f from an order by round(f,9) desc, idx limit 15")
def top_features(spark, sf):
    return compare.top_features(compare.anova(s_long(spark, sf), "label"))


@query(
    f"with {_ANOVA}, fam(feature,family) as (values " + ",".join(f"('{k}','{v}')" for k, v in bank.FAMILY.items()) + f") select family, {R('avg(f)')} as mean_f, {R('max(f)')} as max_f from an join fam using(feature) group by family"
)
def family_ranking(spark, sf):
    return compare.family_ranking(compare.anova(s_long(spark, sf), "label"), bank.FAMILY)


@query(
    f"""with {_ENOUGH}, r as (select a.label, a.idx, a.feature, a.mean as am, a.var as av, sum(b.n*b.mean)/sum(b.n) as rm, sum(b.n*(b.var+b.mean*b.mean))/sum(b.n) as r2 from me a join me b on a.idx=b.idx and a.label<>b.label group by all),
d as (select label, idx, feature, (am-rm)/sqrt((av+greatest(r2-rm*rm,0))/2+1e-9) as d from r), o as (select *, row_number() over (partition by label order by round(abs(d),9) desc, idx) as k from d)
select label, idx, feature, {R('d')} as d from o where k=1"""
)
def one_vs_rest(spark, sf):
    return compare.one_vs_rest(s_long(spark, sf), "label")


_SIGNED_SQL = ",".join(f"'{x}'" for x in bank.SIGNED)
_MAG_SQL = ",".join(f"'{x}'" for x in bank.MAGNITUDE)


@query(
    f"""with {_PAIRS}, s as (select *, row_number() over (partition by class_a, class_b order by round(abs(d),9) desc, idx) as k from pr_ where feature in ({_SIGNED_SQL})),
g as (select class_a, class_b, max(abs(d)) as b from pr_ where feature in ({_MAG_SQL}) group by all)
select g.class_a, g.class_b, {R('b', 9)} as best_magnitude_d, s.feature as best_signed_feature, {R('abs(s.d)', 9)} as best_signed_d from g join s using(class_a, class_b) where k=1 and b<1.0""",
    places=9,
)
def magnitude_blind_pairs(spark, sf):
    return compare.magnitude_blind(compare.class_pairs(compare.moments(s_long(spark, sf), ["label"]), "label"))


_QROWS = ", ".join(f"{_QSQL[c]} as \"{c}\"" for c in bank.Q)
_QLONG = " union all ".join(f'select * exclude ({",".join(chr(34) + x + chr(34) for x in bank.Q)}), {i} as idx, "{c}"::double as value from wq' for i, c in enumerate(bank.Q))


def _qlong_sql(keys: str, window: int, shift: int) -> str:
    """From cp (with class_pos, class_n, keys and sensors) to lq (keys, win, axis, idx, value)."""
    axes = " union all ".join(f"select {keys}, win, {i} as axis, k, {c} as x from cw" for i, c in enumerate(SENSORS))
    return f"""cw as (select *, class_pos-win*{shift} as k from (select *, unnest(range((greatest(0,class_pos-{window}+{shift})//{shift})::bigint, (least(class_pos//{shift},(class_n-{window})//{shift})+1)::bigint)) as win from cp where class_n>={window})),
ax as ({axes}), q0 as (select *, round(avg(x) over w,12) as m, stddev_pop(x) over w as s, lag(x) over (partition by {keys}, win, axis order by k) as p from ax window w as (partition by {keys}, win, axis)), q1 as (select *, x-p as d, round(m+s,12) as ms from q0),
wq as (select {keys}, win, axis, {_QROWS} from q1 group by {keys}, win, axis), lq as ({_QLONG})"""


@query(
    f"""with {LI}, tg as (select flag, session, pos, {",".join(SENSORS)}, s.of_ as of_, (session%4)=s.of_ as own from li cross join (select distinct session%4 as of_ from li) s),
cp as (select *, row_number() over (partition by flag, of_, own order by session, pos)-1 as class_pos, count(*) over (partition by flag, of_, own) as class_n from tg),
{_qlong_sql('flag, of_, own', 20, 10)}, mq as (select flag, of_, own, axis, idx, count(*) as n, avg(value) as m, var_pop(value) as v from lq group by all)
select a.flag as label, a.of_ as source, max(a.n) as n_own, max(b.n) as n_rest, {R('avg(abs((a.m-b.m)/sqrt((a.v+b.v)/2+1e-9)))')} as mean_d, avg(abs((a.m-b.m)/sqrt((a.v+b.v)/2+1e-9)))>=1.5 as outlier
from mq a join mq b on a.flag=b.flag and a.of_=b.of_ and a.axis=b.axis and a.idx=b.idx and a.own and not b.own where a.n>=3 and b.n>=3 group by all"""
)
def source_outlier(spark, sf):
    df = li(spark, sf).withColumn("source", F.col("session") % 4)
    return compare.source_outliers(df, SENSORS, 20, label="flag")


_SPLIT = f"""{LI}, sp as (select case when session%10=0 then 'test' else flag end as part, session, pos, {",".join(SENSORS)} from li), {CP.format('part', 'sp')}"""


def _split_rows(spark, sf) -> DataFrame:
    df = li(spark, sf).withColumn("part", F.when(F.col("session") % 10 == 0, "test").otherwise(F.col("flag")))
    return compare.window_rows(seq.class_position(df, "part"), ["part"], SENSORS, 50, 25)


@query(
    f"""with {_SPLIT}, {_qlong_sql('part', 50, 25)}, mq as (select part, axis, idx, avg(value) as m, var_pop(value) as v from lq group by all),
d as (select b.part as label, abs((a.m-b.m)/sqrt((a.v+b.v)/2+1e-9)) as d from mq a join mq b using(axis, idx) where a.part='test' and b.part<>'test'), g as (select label, avg(d) as mean_d, median(d) as median_d, max(d) as max_d from d group by label)
select label, {R('mean_d')} as mean_d, {R('median_d')} as median_d, {R('max_d')} as max_d, label=(select label from g order by round(mean_d,9), label limit 1) as closest from g"""
)
def closest_class(spark, sf):
    rows = _split_rows(spark, sf)
    long = bank.long_q(rows, ["part", "win"], SENSORS)
    return compare.closest_class(long.filter("part = 'test'"), long.filter("part <> 'test'").withColumnRenamed("part", "label"), "label")


@query(
    f"""with {_SPLIT}, {_qlong_sql('part', 50, 25)}, s as (select part, win, axis, stddev_pop(x) as s from ax group by all)
select part, axis::bigint as axis, {R('quantile_cont(s,0.5)')} as median_std, {R('quantile_cont(s,0.95)')} as p95_std from s group by part, axis"""
)
def std_envelope(spark, sf):
    return compare.std_envelope(_split_rows(spark, sf), ["part"], SENSORS)


# Events

_TWO = f"""{EM}, e2 as (select a.vec_id, a.label, a.k, a.x as ax0, b.x as ax1 from em a join em b on a.vec_id=b.vec_id and b.k=63-a.k)"""


@query(f"with {EM}, a as (select vec_id, k, round(abs(x-avg(x) over (partition by vec_id)),12) as a from em), o as (select *, row_number() over (partition by vec_id order by a desc, k) as r from a) select vec_id, k::bigint as peak from o where r=1")
def peak_position(spark, sf):
    return events.peak_position(em(spark, sf), ["vec_id"])


def _peaks(spark, sf):
    return events.peak_position(em(spark, sf), ["vec_id", "label"])


@query(
    f"""with {EM}, a as (select vec_id, label, k, round(abs(x-avg(x) over (partition by vec_id)),12) as a from em), o as (select *, row_number() over (partition by vec_id order by a desc, k) as r from a),
v as (select label, count(*) as n, floor(quantile_cont(k,0.5))::bigint as median, floor(quantile_cont(k,0.25))::bigint as p25, floor(quantile_cont(k,0.75))::bigint as p75, round(stddev_pop(k),6)+0.0 as std from o where r=1 group by label)
select *, case when std>=25 then 'RAW' when abs(median-32)<=10 and std<15 then 'CENTERED' when abs(median-32)<=10 then 'LOOSE' else 'RAW' end as verdict from v"""
)
def centered_verdict(spark, sf):
    return events.centered_verdict(_peaks(spark, sf), "label", EM_W)


@query(
    f"""with {EM}, d as (select vec_id, k, x, coalesce(x-lag(x) over (partition by vec_id order by k),0) as y from em), s as (select vec_id, stddev_pop(x) as a, stddev_pop(y) as b from d group by vec_id)
select vec_id, case when a>=b then 'x' else 'y' end as axis, {R('greatest(a,b)')} as std from s"""
)
def most_active_axis(spark, sf):
    from pyspark.sql import Window

    d = F.coalesce(F.col("x") - F.lag("x").over(Window.partitionBy("vec_id").orderBy("k")), F.lit(0.0))
    return events.active_axis(em(spark, sf).withColumn("y", d), ["vec_id"], ["x", "y"])


def _signal(spark, sf) -> DataFrame:
    df = seq.class_position(li(spark, sf))
    return df.select("label", F.col("class_pos").alias("pos"), F.col("class_n").alias("n"), F.col("extendedprice").alias("x"))


def _env_sql(source: str, by: str) -> str:
    """From sg (by, pos, n, x) to en (with c, env) and segments sgm (by, start_, end_)."""
    return f"""{source}, c0 as (select *, x-avg(x) over (partition by {by}) as c from sg),
en as (select *, case when pos<n-18 and n>19 then sqrt((min(c) over w)**2+(max(c) over w)**2) end as env from c0 window w as (partition by {by} order by pos rows between current row and 18 following)),
on_ as (select *, env>0.5*avg(env) over (partition by {by}) as o from en where env is not null), sc as (select *, case when lag(o) over (partition by {by} order by pos) is not distinct from o then 0 else 1 end as ch from on_),
si as (select *, sum(ch) over (partition by {by} order by pos) as sid from sc),
sgm as (select {by}, min(pos)+1+9 as start_, case when max(pos)+1<any_value(n)-18 then max(pos)+2 else any_value(n)-18 end+9 as end_ from si where o group by {by}, sid)"""


def _detect_sql(source: str, by: str) -> str:
    """On to peaks pk, kept centers ce and centred windows cw; the strongest peak not within 20 of a kept one is kept next."""
    return f"""{_env_sql(source, by)}, pk0 as (select {by}, start_, en.pos, round(abs(c),9) as a from en join sgm using({by}) where en.pos>=start_ and en.pos<end_),
pk1 as (select *, row_number() over (partition by {by}, start_ order by a desc, pos) as r, count(*) over (partition by {by}, start_) as len from pk0),
pk as (select {by}, pos as peak, row_number() over (partition by {by} order by a desc, pos) as i from pk1 where r=1 and len>1),
nm as (select {by}, i, [peak] as kept from pk where i=1 union all select {by}, pk.i, case when len(list_filter(kept, lambda k: abs(k-pk.peak)<20))=0 then list_append(kept, pk.peak) else kept end from nm join pk using({by}) where pk.i=nm.i+1),
ce as (select {by}, unnest(arg_max(kept, i)) as center from nm group by {by}),
wi as (select {by}, center, center-10 as left_, en.pos, row_number() over (partition by {by}, center order by round(abs(c),9) desc, en.pos) as r, count(*) over (partition by {by}, center) as len from ce join en using({by}) where en.pos>=center-10 and en.pos<center+10),
cw as (select {by}, center, left_ from wi where r=1 and len=20 and left_>=0 and abs(pos-left_-10)<=10)"""


_SIGNAL = f"""{LI}, {CP.format('label', 'li')}, sg as (select label, class_pos as pos, class_n as n, extendedprice as x from cp)"""
_ENV = _env_sql(_SIGNAL, "label")
_DETECT = _detect_sql(_SIGNAL, "label")
_AXES = f"""{LI}, {CP.format('label', 'li')}, sg as ({" union all ".join(f"select label, {i} as axis, class_pos as pos, class_n as n, {a}::double as x from cp" for i, a in enumerate(SENSORS))})"""


@query(f"with {_ENV} select label, pos, {R('env')} as env from en where env is not null")
def envelope(spark, sf):
    return events.envelope(_signal(spark, sf), ["label"], 20).filter("env is not null").select("label", "pos", "env")


@query(f"with {_ENV} select label, start_::bigint as \"start\", end_::bigint as \"end\" from sgm")
def threshold_segments(spark, sf):
    return events.segments(events.envelope(_signal(spark, sf), ["label"], 20).persist(), ["label"], 20)


@query(
    f"""with {_ENV}, j as (select en.label, start_, en.pos, round(abs(c),9) as a from en join sgm on en.label=sgm.label and en.pos>=start_ and en.pos<end_),
o as (select *, row_number() over (partition by label, start_ order by a desc, pos) as r, count(*) over (partition by label, start_) as len from j) select label, pos::bigint as peak, {R('a')} as score from o where r=1 and len>1"""
)
def segment_peaks(spark, sf):
    env = events.envelope(_signal(spark, sf), ["label"], 20).persist()
    return events.peaks(env.withColumn("c", F.round("c", 9)), events.segments(env, ["label"], 20), ["label"])


@query(f"with recursive {_DETECT} select label, center from ce")
def nms_centers(spark, sf):
    return events.detect(_signal(spark, sf), ["label"], 20)[1]


@query(f'with recursive {_DETECT} select label, center, left_ as "left" from cw')
def centered_windows(spark, sf):
    return events.detect(_signal(spark, sf), ["label"], 20)[2]


@query(
    f"""with recursive {_detect_sql(_AXES, 'label, axis')}, de as (select label, axis, count(*) as detected from ce group by all), ke as (select label, axis, count(*) as kept from cw group by all),
al as (select label, axis, coalesce(kept,0) as kept, coalesce(detected,0) as detected from (select distinct label, axis from sg) left join de using(label, axis) left join ke using(label, axis)),
bs as (select *, row_number() over (partition by label order by kept desc, axis) as r from al)
select label, {[*SENSORS]}[axis+1] as axis, kept, detected from bs where r=1"""
)
def auto_work_axis(spark, sf):
    df = seq.class_position(li(spark, sf))
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("x")) for a in SENSORS])).alias("a")
    df = df.select("label", F.col("class_pos").alias("pos"), F.col("class_n").alias("n"), each).select("label", "pos", "n", "a.*")
    return events.best_axis(df, "label", "axis", SENSORS, 20)


# Resampling


@query(
    f"""with {EV}, b as (select session, min(t) as t0, max(t) as t1 from ev group by session), g as (select session, t0, i, t0+21600.0*i as g from b, lateral unnest(range(0, floor((t1-t0)/21600.0)::bigint+1)) as u(i)),
j as (select g.session, g.i, g.g, e.t as ta, e.value as va from g asof join ev e on g.session=e.session and g.g>=e.t), k as (select j.*, e.t as tb, e.value as vb from j asof left join ev e on j.session=e.session and j.g<e.t)
select session, i as step, {R('case when tb is null then va else va+(vb-va)*(g-ta)/(tb-ta) end')} as value from k"""
)
def regrid_linear(spark, sf):
    made = resample.regrid(ev(spark, sf), ["session"], 21600.0, ["value"])
    return made.select("session", "step", "value")


@query(f"with {EV}, r as (select session, pos, round_even(value*2.5,0)+0.0 as value from ev) select * from r")
def integer_requantize(spark, sf):
    return ev(spark, sf).select("session", "pos", resample.requantize(F.col("value") * 2.5).alias("value"))


#: The filter of 50 to 25 Hz by its formula: a sinc at the lower Nyquist rate under a Kaiser window of beta 5, whose Bessel function is summed here.
_TAPS_SQL = """bes(i, b) as (select i, (select sum(power((5.0*sqrt(1-power(i/20.0,2)))/2, 2*k)/power(factorial(k::int)::double,2)) from range(0,30) r(k)) from range(-20,21) t(i)),
h0 as (select i, b*(case when i=0 then 1.0 else sin(pi()*i/2.0)/(pi()*i/2.0) end) as h from bes), taps as (select i, h/(select sum(h) from h0) as h from h0)"""


@query(
    f"""with {LI}, {_TAPS_SQL}, g as (select session, pos, n, quantity as x, first_value(quantity) over w as y0, last_value(quantity) over w as y1 from li where n>=123
 window w as (partition by session order by pos rows between unbounded preceding and unbounded following)),
d as (select *, x-(y0+(y1-y0)*pos/(n-1)) as d from g), o as (select session, n, y0, y1, pos//2 as step from d where pos%2=0),
ot as (select o.*, taps.i, taps.h from o cross join taps), f as (select ot.session, ot.step, any_value(ot.y0+(ot.y1-ot.y0)*ot.step*2/(ot.n-1)) as line, sum(d.d*ot.h) as v from ot join d on d.session=ot.session and d.pos=ot.step*2-ot.i group by ot.session, ot.step)
select session, 0::bigint as run_id, step, {R('step/25.0')} as t, {R('line+v')} as x from f"""
)
def downsample_fir(spark, sf):
    df = li(spark, sf).select("session", F.lit(0).cast("long").alias("run_id"), (F.col("pos") / 50.0).alias("t"), F.col("quantity").alias("x"))
    return resample.downsample(df, ["session", "run_id"], "t", ["x"], source_hz=50.0, target_hz=25.0)


# Predictions

_ARG = "list_position({0}, list_max({0}))-1"
_NOU = "list_transform({0}, lambda v, i: case when i=2 then '-inf'::double else v end)"


@query(f"with {PR} select 0::bigint as stream, pos, ({_ARG.format('p')})::bigint as pred from pr")
def argmax(spark, sf):
    return pr(spark, sf).select("stream", "pos", postprocess.argmax(F.col("p")).alias("pred"))


@query(f"with {PR} select 0::bigint as stream, pos, (case when list_max(p)>=0.3 then {_ARG.format('p')} else -1 end)::bigint as pred from pr")
def threshold(spark, sf):
    return pr(spark, sf).select("stream", "pos", postprocess.threshold(F.col("p"), 0.3).alias("pred"))


_BASE = f"{PR}, b as (select pos, ({_ARG.format('p')})::bigint as pred from pr)"
_STREAK = "{0}c as (select *, case when lag(pred) over (order by pos) is not distinct from pred then 0 else 1 end as ch from {1}), {0}r as (select *, sum(ch) over (order by pos) as run from {0}c), {0}s as (select *, row_number() over (partition by run order by pos) as streak from {0}r)"


@query(
    f"""with {_BASE}, {_STREAK.format('x', 'b')}, y as (select pos, pred, case when streak+(case when run=1 then 1 else 0 end)>=2 then pred end as sure from xs)
select 0::bigint as stream, pos, pred, coalesce(last_value(sure ignore nulls) over (order by pos rows between unbounded preceding and current row),-1)::bigint as out from y"""
)
def consecutive_n(spark, sf):
    base = pr(spark, sf).withColumn("pred", postprocess.argmax(F.col("p")))
    return postprocess.consecutive(base, 2).select("stream", "pos", "pred", "out")


@query(
    f"""with {PR}, b as (select pos, (case when list_max(p)>=0.3 then {_ARG.format('p')} else -1 end)::bigint as pred from pr), v as (select a.pos, c.pred, count(*) as n from b a join b c on c.pos between a.pos-4 and a.pos where c.pred<>-1 group by all),
w as (select pos, pred, row_number() over (partition by pos order by n desc, pred) as k from v) select 0::bigint as stream, b.pos, b.pred, coalesce(w.pred,-1) as out from b left join w on b.pos=w.pos and k=1"""
)
def majority_vote(spark, sf):
    base = pr(spark, sf).withColumn("pred", postprocess.threshold(F.col("p"), 0.3))
    return postprocess.majority(base, 5, CLASSES).select("stream", "pos", "pred", "out")


@query(f"with {PR}, u as (select pos, {_NOU.format('p')} as q from pr) select 0::bigint as stream, pos, (case when list_max(q)>=0.3 then {_ARG.format('q')} else -1 end)::bigint as pred from u")
def exclude_unknown(spark, sf):
    return pr(spark, sf).select("stream", "pos", postprocess.exclude_unknown(F.col("p"), 0.3).alias("pred"))


_EMA = f"""with recursive {PR}, o as (select pos, p, row_number() over (order by pos) as i from pr),
em_ as (select i, pos, p as e from o where i=1 union all select o.i, o.pos, list_transform(list_zip(o.p, em_.e), lambda z: 0.3::double*z[1]+0.7::double*z[2]) from em_ join o on o.i=em_.i+1)"""


@query(_EMA + " select 0::bigint as stream, pos, " + ", ".join(f"{R(f'e[{i + 1}]')} as e{i}" for i in range(CLASSES)) + " from em_")
def ema(spark, sf):
    return postprocess.ema(pr(spark, sf)).select("stream", "pos", *[F.get("e", F.lit(i)).alias(f"e{i}") for i in range(CLASSES)])


@query(
    _EMA
    + f""", u as (select pos, e, {_NOU.format('e')} as q from em_), sw as (select pos, e, q, ({_ARG.format('e')})=1 and list_max(e)-list_max(q)<0.2 as sw from u),
cl as (select pos, case when (case when sw then list_max(q) else list_max(e) end)>=0.2 then (case when sw then {_ARG.format('q')} else {_ARG.format('e')} end) else -1 end::bigint as pred from sw),
{_STREAK.format('x', 'cl')}, y as (select pos, pred, case when streak>=2 and pred<>-1 then pred end as sure from xs)
select 0::bigint as stream, pos, pred, coalesce(last_value(sure ignore nulls) over (order by pos rows between unbounded preceding and current row),-1)::bigint as out from y"""
)
def production_pipe(spark, sf):
    return postprocess.production(pr(spark, sf), least=0.2)


@query(f"with {_BASE}, {_STREAK.format('x', 'b')} select 0::bigint as stream, pred as class, min(pos) as start, max(pos)+1 as \"end\", count(*) as len from xs group by run, pred")
def episodes(spark, sf):
    return postprocess.episodes(pr(spark, sf).withColumn("pred", postprocess.argmax(F.col("p"))))


@query(
    f"""with {PR}, e as (select pos, generate_subscripts(p,1)-1 as class, unnest(p) as v from pr), k as (select *, row_number() over (partition by pos order by v desc, class) as r from e)
select class::bigint as class, {R('max(v)')} as max_p, {R('avg(v)')} as mean_p, count(*) filter (where r=1) as top1, count(*) filter (where r=2) as top2, count(*) filter (where r=3) as top3, count(*) filter (where r>3) as never_top3, max(v)<0.1 as dead from k group by class"""
)
def ceiling_check(spark, sf):
    return postprocess.ceiling(pr(spark, sf), CLASSES)


def _comparison_sql() -> str:
    """Every pipeline's (name, pos, out) in one table, then frames and episodes by class."""
    arg, parts, made = f"({_ARG.format('p')})::bigint", [f"b as (select pos, p, ({_ARG.format('p')})::bigint as pred from pr)"], []
    parts.append(_STREAK.format("x", "b"))
    made.append("select 'argmax' as pipeline, pos, pred as out from b")
    made += [f"select 'threshold={t}', pos, case when list_max(p)>={t} then {arg} else -1 end from pr" for t in (0.50, 0.80, 0.95, 0.99)]
    sure = "coalesce(last_value(case when {0} then pred end ignore nulls) over (order by pos rows between unbounded preceding and current row),-1)"
    made += [f"select 'consecutive={n}', pos, {sure.format(f'streak+(case when run=1 then 1 else 0 end)>={n}')} from xs" for n in (2, 3, 5)]
    for k in (3, 5, 7):
        parts.append(f"v{k} as (select a.pos, c.pred, count(*) as n from b a join b c on c.pos between a.pos-{k - 1} and a.pos where c.pred<>-1 group by all), w{k} as (select pos, pred, row_number() over (partition by pos order by n desc, pred) as r from v{k})")
        made.append(f"select 'majority={k}', pos, pred from w{k} where r=1")
    nou = "list_transform({0}, lambda v, i: case when i=2 then '-inf'::double else v end)"
    parts.append(f"u as (select pos, {nou.format('p')} as q from pr)")
    made += [f"select 'no-unknown={t}', pos, case when list_max(q)>={t} then ({_ARG.format('q')})::bigint else -1 end from u" for t in (0.1, 0.3, 0.5)]
    parts.append("o as (select pos, p, row_number() over (order by pos) as i from pr)")
    for a in (1, 3, 5):
        parts.append(f"e{a} as (select i, pos, p as e from o where i=1 union all select o.i, o.pos, list_transform(list_zip(o.p, e{a}.e), lambda z: {a / 10}::double*z[1]+{1 - a / 10}::double*z[2]) from e{a} join o on o.i=e{a}.i+1)")
        made.append(f"select 'ema={a / 10}', pos, ({_ARG.format('e')})::bigint from e{a}")
    parts.append(f"pq as (select pos, e, {nou.format('e')} as q from e3), sw as (select pos, e, q, ({_ARG.format('e')})=1 and list_max(e)-list_max(q)<0.2 as sw from pq)")
    parts.append(f"cl as (select pos, case when (case when sw then list_max(q) else list_max(e) end)>=0.6 then (case when sw then {_ARG.format('q')} else {_ARG.format('e')} end) else -1 end::bigint as pred from sw)")
    parts.append(_STREAK.format("z", "cl"))
    made.append(f"select 'production', pos, {sure.format('streak>=2 and pred<>-1')} from zs")
    return f"""with recursive {PR}, {", ".join(parts)}, al as ({" union all ".join(made)}),
ch as (select *, case when lag(out) over (partition by pipeline order by pos) is not distinct from out then 0 else 1 end as ch from al)
select pipeline, out::bigint as class, count(*) as frames, sum(ch)::bigint as episodes from ch group by pipeline, out"""


@query(_comparison_sql())
def pipeline_comparison(spark, sf):
    return postprocess.comparison(pr(spark, sf), CLASSES)


@query(
    f"""with {EV}, l as (select session, pos, value as a, lag(value,1) over w as b, lag(value,2) over w as c from ev window w as (partition by session order by pos))
select session as stream, pos, {R('case when c is null then a else list_sort([a,b,c])[2] end')} as y from l"""
)
def median3(spark, sf):
    df = ev(spark, sf).select(F.col("session").alias("stream"), "pos", F.col("value").alias("x"))
    return postprocess.median3(df).select("stream", "pos", "y")


_MASKS = ["0x0c00010300000000", "0x0000000f00000000", "0xfffffff000000001"]


@query(
    "with m(axis, w) as (values " + ",".join(f"({i}::bigint, {int(m[2:10], 16)}::bigint)" for i, m in enumerate(_MASKS)) + "), n(bit, feature) as (values "
    + ",".join(f"({i}::bigint,'{f}')" for i, f in enumerate(labels.MASK_BITS)) + ") select axis, bit, feature, (w>>bit::int)&1=1 as enabled from m cross join n"
)
def mask_decode(spark, sf):
    source = "FEATURES_EXTRACTION_MASK[] = {" + ", ".join(_MASKS) + "};"
    return labels.decode_masks(spark.createDataFrame([(source,)], "source string"))


# Rules

_RULES = f"""with {EV}, {runs_sql('ev')}, r as (select 'class_imbalance' as code, 1 as rank, 'quality' as subject from (select max(n)/min(n) as x from (select count(*) as n from labels group by quality)) where x>=3
union all select 'class_below_min_samples', 4, toxic::varchar from labels group by toxic having count(*)<20
union all select 'class_run_below_window', 2, label from rt group by label having max(len)<6
union all select 'session_below_window', 2, session::varchar from ev group by session having count(*)<60
union all select 'recommended_dtype', 1, 'FLOAT32')"""


@query(_RULES + " select code, case rank when 4 then 'hard-reject' when 2 then 'will-lose-data' else 'advisory' end as severity, subject from r")
def rules_findings(spark, sf):
    from tidemark.plans import rules

    return rules.demo_findings(ev(spark, sf), table(spark, sf, "labels")).select("code", "severity", "subject")


@query(_RULES + " select case when max(rank)>=3 then 'FIX_REQUIRED' when max(rank)=2 then 'WILL_LOSE_DATA' else 'PASS' end as verdict, count(*) as findings from r")
def verdict(spark, sf):
    from tidemark.plans import rules

    return rules.verdict(rules.demo_findings(ev(spark, sf), table(spark, sf, "labels")))


# Forms with invalid labels, zero seeds and usage counts


@query(
    f"""with {EV}, iv as (select session, pos, n, case when event_id%13=0 then null else label end as label from ev), {runs_sql('iv')}, g as (select *, run_end-pos>=3 and label is not null as pure from rn where pos%2=0 and pos+3<=n),
tot as (select count(*) as total_windows, coalesce(sum((not pure)::int),0)::bigint as mixed_windows from g), ls as (select distinct label from rn where label is not null), pw as (select label, count(*) as c from g where pure group by label)
select ls.label, coalesce(c,0) as pure_windows, total_windows, mixed_windows from ls left join pw using(label) cross join tot"""
)
def pure_windows_invalid_labels(spark, sf):
    df = ev(spark, sf).withColumn("label", F.when(F.col("event_id") % 13 != 0, F.col("label")))
    return seq.pure_windows(df, 3, 2)


@query("select count(*) filter (where event_id%13=0) as invalid_rows, count(*) as rows from events")
def invalid_label_rows(spark, sf):
    df = ev(spark, sf).withColumn("label", F.when(F.col("event_id") % 13 != 0, F.col("label")))
    return df.agg(F.count_if(~seq.valid_label(F.col("label"))).alias("invalid_rows"), F.count("*").alias("rows"))


@query(
    _EMA.replace("select i, pos, p as e from o", "select i, pos, list_transform(p, lambda v: 0.3::double*v) as e from o")
    + f""", u as (select pos, e, {_NOU.format('e')} as q from em_), sw as (select pos, e, q, ({_ARG.format('e')})=1 and list_max(e)-list_max(q)<0.2 as sw from u)
select 0::bigint as stream, pos, (case when sw then {_ARG.format('q')} else {_ARG.format('e')} end)::bigint as pred, {R('case when sw then list_max(q) else list_max(e) end')} as confidence from sw"""
)
def firmware_margin(spark, sf):
    from tidemark.streaming import stateful

    return stateful.batch(pr(spark, sf)).select("stream", "pos", "pred", "confidence")


@query(
    _EMA.replace("select i, pos, p as e from o", "select i, pos, list_transform(p, lambda v: 0.3::double*v) as e from o")
    + f""", u as (select i, pos, e, {_NOU.format('e')} as q from em_), pd as (select i, pos, (case when ({_ARG.format('e')})=1 and list_max(e)-list_max(q)<0.2 then {_ARG.format('q')} else {_ARG.format('e')} end)::bigint as pred from u),
tr as (select i, pos, pred, pred not in (0,1) as fired, case when pred in (0,1) then -1 else pred end as last, case when pred in (0,1) then 1 else 0 end as quiet from pd where i=1
union all select pd.i, pd.pos, pd.pred, pd.pred not in (0,1) and pd.pred<>tr.last, case when pd.pred not in (0,1) then pd.pred when tr.quiet+1>=3 then -1 else tr.last end, case when pd.pred in (0,1) then tr.quiet+1 else 0 end from tr join pd on pd.i=tr.i+1)
select 0::bigint as stream, pos, pred from tr where fired"""
)
def event_transitions(spark, sf):
    from tidemark.streaming import stateful

    return stateful.batch(pr(spark, sf)).filter("event").select("stream", "pos", "pred")


@query(
    f"""with {PR}, b as (select pos, (case when list_max(p)>=0.3 then {_ARG.format('p')} else -1 end)::bigint as pred from pr), {_STREAK.format('x', 'b')}
select 'threshold' as pipeline, pred as class, count(*) as frames, sum((streak=1)::int)::bigint as episodes from xs group by pred"""
)
def frame_counts(spark, sf):
    made = pr(spark, sf).withColumn("out", postprocess.threshold(F.col("p"), 0.3))
    return postprocess.frame_report(made, "threshold")


@query(
    "with m(axis, w) as (values " + ",".join(f"({i}::bigint, {int(m[2:10], 16)}::bigint)" for i, m in enumerate(_MASKS)) + "), n(bit, feature) as (values "
    + ",".join(f"({i}::bigint,'{f}')" for i, f in enumerate(labels.MASK_BITS)) + "), d as (select axis, feature, (w>>bit::int)&1=1 as e from m cross join n) select feature, count(*) filter (where e) as axes, not bool_or(e) as missing from d group by feature"
)
def mask_usage(spark, sf):
    made = mask_decode(spark, sf)
    return made.groupBy("feature").agg(F.count_if("enabled").alias("axes"), (~F.bool_or("enabled")).alias("missing"))


@query("select count(*) filter (where value is null) + count(*) filter (where event_type is null) + count(*) filter (where ts is null) as null_cells, count(*) as rows from events")
def null_census(spark, sf):
    df = table(spark, sf, "events")
    cells = [F.count_if(F.col(c).isNull()) for c in ("value", "event_type", "ts")]
    return df.agg((cells[0] + cells[1] + cells[2]).alias("null_cells"), F.count("*").alias("rows"))


@query(f"with {LI}, {CP.format('flag', 'li')} select flag, class_pos, quantity from cp where class_n<=5 or (class_pos>=3 and class_pos<class_n-3 and class_n>6)")
def class_edge_trim(spark, sf):
    made = seq.class_position(li(spark, sf), "flag")
    keep = (F.col("class_n") <= 6) | ((F.col("class_pos") >= 3) & (F.col("class_pos") < F.col("class_n") - 3))
    return made.filter(keep).select("flag", "class_pos", "quantity")


@query("with n(k) as (select unnest(range(0,300))) select k, k>=1 and (k & (k-1))=0 as pow2, k in (128,256) as fft_window from n")
def power_of_two(spark, sf):
    k = F.col("k")
    return spark.range(300).select(F.col("id").alias("k")).select("k", parsing.is_power_of_two(k).alias("pow2"), (parsing.is_power_of_two(k) & k.between(128, 2048)).alias("fft_window"))
