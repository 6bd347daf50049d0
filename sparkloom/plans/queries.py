"""Queries over the test tables, one for each operator, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.keeping import kept
from ..operators import catalog, derivatives, entities, keys, labels, layout, lookups, measures, near, tasks, texts
from . import training

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The test tables by name, and what they stand for here."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def files(self) -> DataFrame:
        return self.documents.select(F.col("doc_id").alias("file_pk"), F.md5(F.col("text").cast("binary")).alias("content_hash"), F.lit(1).alias("status"))

    def tasks(self) -> DataFrame:
        """Events as tasks of the run `user_id`: signup is pending, view in work, click and purchase done."""
        status = F.when(F.col("event_type") == "signup", "pending").when(F.col("event_type") == "view", "processing").when(F.col("event_type") == "error", "error").otherwise("done")
        due = F.when(F.col("event_id") % 3 == 0, F.col("ts"))
        return self.events.select(F.col("event_id").alias("file_pk"), F.format_string("p%03d/%d", F.col("event_id") % 97, "event_id").alias("path"), F.col("user_id").alias("run_id"), status.alias("status"), (F.col("event_id") % 3).cast("int").alias("attempt"), F.col("ts").alias("started_at"), due.alias("next_run_at"), F.col("value").alias("latency_ms"))

    def vocabulary(self) -> DataFrame:
        return self.region.select(F.col("r_regionkey").alias("label_id"), F.col("r_name").alias("name"))

    def predictions(self) -> DataFrame:
        made = F.array(F.col("quality"), F.col("toxic") + 2, F.col("quality") + F.col("toxic") + 4)
        return self.labels.select(F.col("doc_id").alias("file_pk"), made.alias("labels"))

    def truth(self) -> DataFrame:
        """Two labels a document: truth from quality, prediction from toxic."""
        return self.labels.select(F.col("doc_id").alias("sample"), F.explode(F.array(F.lit(0), F.lit(1))).alias("label"), "quality", "toxic").select("sample", "label", (F.col("quality") == F.col("label")).alias("truth"), (F.col("toxic") == F.col("label")).alias("predicted"))

    def scores(self) -> DataFrame:
        e = self.embeddings.select("vec_id", "label", F.posexplode(F.slice("embedding", 1, 8)).alias("place", "x"))
        return e.select(F.col("vec_id").alias("sample"), F.col("place").alias("label"), (F.col("label") % 8 == F.col("place")).alias("truth"), (F.col("x").cast("double") / 2 + 0.5).alias("score"))

    def mentions(self) -> DataFrame:
        return self.lineitem.select(F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("entity"), F.col("l_linenumber").alias("pos"), F.col("l_discount").alias("confidence"), F.col("l_returnflag").alias("type"))

    def concepts(self) -> DataFrame:
        n = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return n.select(F.col("n_name").alias("name"), F.col("r_name").alias("parent"), F.col("n_nationkey").alias("pos"))

    def blocks(self) -> DataFrame:
        """Events as blocks of the page `user_id`."""
        side = lambda k: (F.col("event_id") % k + 5).cast("double")
        return self.events.select(F.col("user_id").alias("page"), F.col("event_id").alias("block"), (F.col("event_id") * 37 % 600).cast("double").alias("x"), (F.col("event_id") * 91 % 800 - 40).cast("double").alias("y"), side(40).alias("w"), side(15).alias("h"))


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


FILES = "(select doc_id as file_pk, md5(text) as content_hash, 1 as status from documents) files"
TASKS = """(select event_id as file_pk, printf('p%03d/%d', event_id % 97, event_id) as path, user_id as run_id,
    case event_type when 'signup' then 'pending' when 'view' then 'processing' when 'error' then 'error' else 'done' end as status,
    cast(event_id % 3 as integer) as attempt, ts as started_at, case when event_id % 3 = 0 then ts end as next_run_at, value as latency_ms from events) tasks"""
MENTIONS = "(select l_orderkey as image, l_partkey as entity, l_linenumber as pos, l_discount as confidence, l_returnflag as type from lineitem) mentions"
BLOCKS = """(select user_id as page, event_id as block, cast(event_id * 37 % 600 as double) as x, cast(event_id * 91 % 800 - 40 as double) as y,
    cast(event_id % 40 + 5 as double) as w, cast(event_id % 15 + 5 as double) as h from events) blocks"""
TRUTH = "(select doc_id as sample, label, quality = label as truth, toxic = label as predicted from labels, (values (0), (1)) v(label)) pairs"
PREDICTIONS = "(select doc_id as file_pk, [quality, toxic + 2, quality + toxic + 4] as labels from labels) predictions"


# --- catalogue -------------------------------------------------------------------------------------------------------


def _listing(t: Tables) -> DataFrame:
    return t.documents.select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size"), (F.col("doc_id") * 1000).alias("mtime"))


def _catalog(t: Tables) -> DataFrame:
    d = t.documents.filter("doc_id % 10 < 8")
    return d.select((F.col("doc_id") + 1).alias("file_pk"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), (F.col("n_chars") + F.when(F.col("doc_id") % 7 == 0, 1).otherwise(0)).alias("size"), (F.col("doc_id") * 1000).alias("mtime"), F.lit(1).alias("status"), F.md5(F.col("text").cast("binary")).alias("content_hash"))


CATALOG = """(select doc_id + 1 as file_pk, source || '/' || doc_id as path, n_chars + case when doc_id % 7 = 0 then 1 else 0 end as size,
    doc_id * 1000 as mtime, md5(text) as content_hash from documents where doc_id % 10 < 8) catalog"""
LISTING = "(select source || '/' || doc_id as path, n_chars as size, doc_id * 1000 as mtime from documents) listing"


@query("scan_changes", f"""
    select l.path, case when c.path is null then 'new' when c.size = l.size and c.mtime = l.mtime then 'same' else 'changed' end as change
    from {LISTING.replace(") listing", ") l")} left join {CATALOG.replace(") catalog", ") c")} on l.path = c.path""")
def scan_changes(t):
    return catalog.listing_changes(_listing(t), _catalog(t)).select("path", "change")


@query("scan_merge", f"""
    with c as (select * from {CATALOG}), l as (select * from {LISTING}), top as (select max(file_pk) as top from c)
    select coalesce(file_pk, top + row_number() over (partition by file_pk is null order by path)) as file_pk, path, coalesce(l.size, c.size) as size,
           cast(case when c.path is null or l.size <> c.size then 0 else 1 end as integer) as status, case when l.size = c.size then content_hash end as content_hash
    from l full join c using (path), top""")
def scan_merge(t):
    return catalog.merged_catalog(_listing(t), _catalog(t)).select("file_pk", "path", "size", "status", "content_hash")


@query("scan_dependents", f"""
    select o_orderkey from orders where o_custkey not in (
        select file_pk from {CATALOG} join {LISTING} using (path) where catalog.size <> listing.size)""")
def scan_dependents(t):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("file_pk"))
    return catalog.without_dependents(rows, catalog.listing_changes(_listing(t), _catalog(t)).select("path", "change"), _catalog(t).select("path", "file_pk")).select("o_orderkey")


@query("exact_dedupe", f"""
    select file_pk, content_hash, min(file_pk) over (partition by content_hash) as canonical_pk,
           file_pk <> min(file_pk) over (partition by content_hash) as is_exact_dupe from {FILES}""")
def exact_dedupe(t):
    return catalog.exact_duplicates(t.files()).select("file_pk", "content_hash", "canonical_pk", "is_exact_dupe")


@query("dedupe_totals", f"select count(*) as candidates, count(distinct content_hash) as uniques, count(*) - count(distinct content_hash) as dupes from {FILES}")
def dedupe_totals(t):
    return catalog.duplicate_totals(catalog.exact_duplicates(t.files()))


@query("claim_faults", f"""
    with f as (select * from {FILES}), claims as (
        select content_hash || case when min(file_pk) % 11 = 0 then 'x' else '' end as content_hash, min(file_pk) as canonical_file_pk
        from f where file_pk % 13 <> 0 group by content_hash)
    select c.content_hash, 'stale' as fault from claims c left join f on f.file_pk = c.canonical_file_pk where f.content_hash is distinct from c.content_hash
    union all select distinct content_hash, 'missing' from f where content_hash not in (select content_hash from claims)""")
def claim_faults(t):
    own = t.files().filter("file_pk % 13 <> 0").groupBy("content_hash").agg(F.min("file_pk").alias("canonical_file_pk"))
    claims = own.select(F.concat("content_hash", F.when(F.col("canonical_file_pk") % 11 == 0, "x").otherwise("")).alias("content_hash"), "canonical_file_pk")
    return catalog.claim_faults(claims, t.files())


@query("bucket_assign", f"""
    with c as (select min(file_pk) as file_pk from {FILES} group by content_hash), i as (select file_pk, row_number() over (order by file_pk) - 1 as ok_index from c)
    select file_pk, ok_index, ok_index // 100 as bucket_id, ok_index % 100 as bucket_pos from i""")
def bucket_assign(t):
    rows = catalog.canonical(catalog.exact_duplicates(t.files()))
    return catalog.bucketed(rows, 100).select("file_pk", "ok_index", "bucket_id", "bucket_pos")


@query("next_key", "select coalesce(max(doc_id) + 1, 1) as next_key from documents")
def next_key(t):
    return keys.next_key(t.documents, "doc_id")


@query("missing_presets", """
    with p as (select distinct o_orderpriority as preset from orders), d as (select distinct o_custkey, o_orderpriority from orders where o_orderstatus = 'F')
    select c_custkey as file_pk, preset from customer, p where not exists (select 1 from d where o_custkey = c_custkey and o_orderpriority = preset)""")
def missing_presets(t):
    done = t.orders.select(F.col("o_custkey").alias("file_pk"), F.col("o_orderpriority").alias("preset"), (F.col("o_orderstatus") == "F").cast("int").alias("status"))
    return catalog.missing_presets(t.customer.select(F.col("c_custkey").alias("file_pk")), t.orders.select(F.col("o_orderpriority").alias("preset")).distinct(), done)


@query("preset_progress", """
    select c_custkey as file_pk, count(distinct o_orderpriority) filter (o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')) as n_have,
           coalesce(string_agg(distinct o_orderpriority, ',' order by o_orderpriority) filter (o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')), '') as have
    from customer left join orders on o_custkey = c_custkey group by 1 having n_have < 3""")
def preset_progress(t):
    done = t.orders.select(F.col("o_custkey").alias("file_pk"), F.col("o_orderpriority").alias("preset"), (F.col("o_orderstatus") == "F").cast("int").alias("status"))
    return catalog.preset_progress(t.customer.select(F.col("c_custkey").alias("file_pk")), done, ["1-URGENT", "2-HIGH", "5-LOW"]).select("file_pk", "n_have", F.array_join("have", ",").alias("have"))


@query("upsert_latest", """
    with new as (select doc_id as k, quality as v from labels), old as (select doc_id as k, -1 as v from documents where doc_id % 2 = 0)
    select k, cast(v as integer) as v from new union all select k, cast(v as integer) from old where k not in (select k from new)""")
def upsert_latest(t):
    old = t.documents.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("k"), F.lit(-1).alias("v"))
    return keys.upsert(old, t.labels.select(F.col("doc_id").alias("k"), F.col("quality").alias("v")), ["k"])


@query("insert_missing", """
    with old as (select doc_id as k from documents where doc_id % 2 = 0)
    select k from old union select doc_id from labels""")
def insert_missing(t):
    old = t.documents.filter("doc_id % 2 = 0").select(F.col("doc_id").alias("k"))
    return keys.insert_missing(old, t.labels.select(F.col("doc_id").alias("k")), ["k"])


@query("latest_per_key", """
    select user_id, event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n = 1""")
def latest_per_key(t):
    return keys.latest(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


# --- near-duplicates -------------------------------------------------------------------------------------------------

HASHES = """(select vec_id as file_pk, cast(list_sum(list_transform(range(1, 64), lambda i: case when embedding[i] > 0 then 1::hugeint << (i - 1)::int else 0::hugeint end)) as bigint) as hash from embeddings) hashes"""


def _hashes(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("file_pk"), near.sign_hash("embedding").alias("hash"))


@query("hamming_pairs", f"""
    with h as (select min(file_pk) as k, hash from {HASHES} group by hash)
    select a.k as a, b.k as b, cast(bit_count(xor(a.hash, b.hash)) as integer) as distance
    from h a join h b on a.k < b.k where bit_count(xor(a.hash, b.hash)) between 1 and 8""")
def hamming_pairs(t):
    return near.close_pairs(_hashes(t).groupBy("hash").agg(F.min("file_pk").alias("key")), 8)


@query("near_marked", f"""
    with f as (select * from {HASHES}), h as (select min(file_pk) as k, hash from f group by hash),
    n as (select b.k as b, min(a.k) as near from h a join h b on a.k < b.k where bit_count(xor(a.hash, b.hash)) between 1 and 8 group by 1)
    select file_pk, case when file_pk <> k then k else near end as dupe_of from f join h using (hash) left join n on n.b = k""")
def near_marked(t):
    return near.marked_near(_hashes(t), 8)


# --- tasks -----------------------------------------------------------------------------------------------------------


@query("tasks_created", f"""
    with c as (select min(file_pk) as file_pk from {FILES} group by content_hash),
    i as (select file_pk, row_number() over (order by file_pk) - 1 as n from c), o as (select distinct event_id from events where user_id = 7)
    select file_pk, cast(7 as bigint) as run_id, 'pending' as status, cast(0 as integer) as attempt from i
    where ((n + 1) * 30) // 100 > (n * 30) // 100 and file_pk not in (select event_id from o)""")
def tasks_created(t):
    rows = catalog.canonical(catalog.exact_duplicates(t.files()))
    out = tasks.created(t.tasks(), rows, 7, 30)
    return out.withColumn("run_id", F.col("run_id").cast("long"))


@query("tasks_recovered", f"""
    select file_pk, case when status = 'processing' then 'pending' else status end as status, case when status <> 'processing' then started_at end as started_at from {TASKS}""")
def tasks_recovered(t):
    return tasks.recovered(t.tasks()).select("file_pk", "status", "started_at")


@query("tasks_claimed", f"""
    select file_pk, path, cast(attempt + 1 as integer) as attempt from {TASKS}
    where status = 'pending' and (next_run_at is null or next_run_at <= timestamp '2024-01-15 00:00:00') order by path, file_pk limit 64""")
def tasks_claimed(t):
    return tasks.claimed(t.tasks(), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), 64)


@query("tasks_after_results", f"""
    select file_pk, attempt,
           case when status <> 'processing' or file_pk % 4 = 3 then status when file_pk % 4 = 0 then 'done' when attempt < 2 then 'pending' else 'error' end as status,
           case when status = 'processing' and file_pk % 4 in (1, 2) then 'boom' end as last_error,
           case when status = 'processing' and file_pk % 4 in (1, 2) and attempt < 2 then epoch_us(started_at) + cast(round(least(0.5 * pow(2, attempt - 1), 30) * 1000000) as bigint) end as next_run_us
    from {TASKS}""")
def tasks_after_results(t):
    results = t.events.filter("event_id % 4 <> 3").select(F.col("event_id").alias("file_pk"), (F.col("event_id") % 4 == 0).alias("ok"), F.lit("boom").alias("error"), F.col("ts").alias("finished_at"))
    return tasks.after_results(t.tasks(), results, attempts=2, base=0.5, factor=2, most=30)


@query("status_counts", f"""
    with n as (select run_id, count(*) filter (status = 'pending') as pending, count(*) filter (status = 'processing') as processing,
        count(*) filter (status = 'done') as done, count(*) filter (status = 'error') as error from {TASKS} group by 1)
    select *, case when processing > 0 then 'processing' when pending > 0 then 'pending' when error > 0 then 'error' else 'done' end as run_status from n""")
def status_counts(t):
    return tasks.status_counts(t.tasks())


@query("run_progress", f"""
    select run_id, 100.0 * count(*) filter (status in ('done', 'error')) / count(*) as percent,
           cast(count(*) filter (status in ('pending', 'processing')) as double) / 2.5 as seconds_left from {TASKS} group by 1""")
def run_progress(t):
    return tasks.progress(tasks.status_counts(t.tasks()), 2.5)


@query("recent_runs", "select run_id, last_ts from (select user_id as run_id, max(ts) as last_ts from events group by 1) order by last_ts desc, run_id limit 50")
def recent_runs(t):
    return t.events.groupBy(F.col("user_id").alias("run_id")).agg(F.max("ts").alias("last_ts")).orderBy(F.desc("last_ts"), "run_id").limit(50)


@query("asset_rows", f"""
    select tasks.file_pk, path, status, labels.quality from {TASKS} left join labels on labels.doc_id = tasks.file_pk order by path, file_pk limit 1000""")
def asset_rows(t):
    own = t.tasks().join(t.labels.select(F.col("doc_id").alias("file_pk"), "quality"), "file_pk", "left")
    return own.select("file_pk", "path", "status", "quality").orderBy("path", "file_pk").limit(1000)


# --- measures --------------------------------------------------------------------------------------------------------


@query("latency_percentiles", "select event_type, quantile_disc(value, 0.5) as p50, quantile_disc(value, 0.95) as p95, quantile_disc(value, 0.99) as p99, quantile_disc(value, 1.0) as p100 from events group by 1")
def latency_percentiles(t):
    return measures.percentiles(t.events, ["event_type"], "value", [50, 95, 99, 100])


@query("queue_upper_median", """
    with r as (select event_type, value, row_number() over (partition by event_type order by value) - 1 as i, count(*) over (partition by event_type) as n from events)
    select event_type, value as upper_median from r where i = n // 2""")
def queue_upper_median(t):
    return measures.upper_median(t.events, ["event_type"], "value")


@query("dashboard_percentiles", """
    with r as (select user_id, value, row_number() over (partition by user_id order by value) - 1 as i, count(*) over (partition by user_id) as n from events)
    select user_id, min(value) filter (i = n // 2) as p50, min(value) filter (i = case when n > 20 then (n * 95) // 100 else n - 1 end) as p95 from r group by 1""")
def dashboard_percentiles(t):
    return measures.dashboard_percentiles(t.events, ["user_id"], "value")


@query("latency_histogram", """
    with e as (select min(value) as lo, max(value) as hi from events), c as (
        select cast(least(19, floor((value - lo) / ((hi - lo) / 20))) as integer) as bin, count(*) as n from events, e group by 1)
    select cast(b as integer) as bin, lo + b * ((hi - lo) / 20) as low, coalesce(n, 0) as n from e, range(20) r(b) left join c on c.bin = b""")
def latency_histogram(t):
    return measures.histogram(t.events, "value", 20)


@query("run_rates", """
    select user_id, count(*) as n, count(*) filter (event_type = 'error') as errors, 100.0 * count(*) filter (event_type = 'error') / count(*) as error_percent, avg(value) as mean,
           case when max(ts) > min(ts) then count(*) * 1e6 / (epoch_us(max(ts)) - epoch_us(min(ts))) end as per_second from events group by 1""")
def run_rates(t):
    return measures.rates(t.events.withColumn("is_error", F.col("event_type") == "error"), ["user_id"])


@query("token_rates", """
    select event_type, case when sum(event_id % 50) > 0 then sum(event_id % 50) / case when sum(case when event_id % 2 = 0 then value else 0 end) > 0 then sum(case when event_id % 2 = 0 then value else 0 end) else 60 end end as tokens_per_second
    from events group by 1""")
def token_rates(t):
    rows = t.events.select("event_type", (F.col("event_id") % 50).alias("completion_tokens"), F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(0.0).alias("generation_s"))
    return measures.token_rates(rows, ["event_type"], wall_seconds=60.0)


@query("batch_efficiency", "select avg(100.0 * (event_id % 9) / 8) as batch_efficiency from events")
def batch_efficiency(t):
    return measures.batch_efficiency(t.events.select((F.col("event_id") % 9).alias("actual"), F.lit(8).alias("size")))


@query("last_samples", "select event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events) where n <= 3")
def last_samples(t):
    return measures.last_n(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("event_id")


@query("moving_mean", "select event_id, avg(value) over (partition by user_id order by ts, event_id rows between 9 preceding and current row) as moving_mean from events")
def moving_mean(t):
    return measures.moving_mean(t.events, ["user_id"], ["ts", "event_id"], "value", 10).select("event_id", "moving_mean")


@query("decayed_mean", """
    with recursive o as (select user_id, epoch_us(ts) / 1e6 as s, value as v, row_number() over (partition by user_id order by ts, value) as i from events),
    f as (select user_id, i, s, v as m from o where i = 1
          union all select o.user_id, o.i, o.s, m + (1 - pow(0.5, (o.s - f.s) / 3600)) * (o.v - m) from f join o on o.user_id = f.user_id and o.i = f.i + 1)
    select user_id, last(m order by i) as decayed_mean from f group by 1""")
def decayed_mean(t):
    rows = t.events.withColumn("seconds", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return measures.decayed_mean(rows, ["user_id"], "seconds", "value", 3600.0)


@query("sparkline", """
    with o as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events), k as (select * from o where n <= 15),
    x as (select user_id, ts, event_id, cast(least(8, floor((value - min(value) over w) / greatest(1e-9, max(value) over w - min(value) over w) * 8)) as integer) as i from k window w as (partition by user_id))
    select user_id, string_agg(substr(' ▁▂▃▄▅▆▇█', i + 1, 1), '' order by ts, event_id) as line from x group by 1""")
def sparkline(t):
    return measures.sparkline(t.events, ["user_id"], ["ts", "event_id"], "value", 15)


@query("tuning", """
    with m as (select user_id, quantile_disc(value, 0.95) as p95, 100.0 * count(*) filter (event_type = 'error') / count(*) as er, count(*) as n from events group by 1),
    d as (select *, case when n < 5 then 'warmup' when er > 30 or p95 > 1.10 * 100 then 'scale_down' when p95 < 0.85 * 100 then 'scale_up' else 'hold' end as decision from m),
    s as (select *, case decision when 'scale_up' then 1 when 'scale_down' then -1 else 0 end as way from d)
    select user_id, cast(greatest(8, least(256, case when p95 < 0.85 * 100 then 32 + 4 when p95 > 1.10 * 100 then 32 - 4 else 32 end)) as integer) as concurrency, decision,
           cast(case when decision = 'warmup' then 32 else greatest(8, least(256, 32 + 4 * way)) end as integer) as inflight,
           cast(case when decision = 'warmup' then 64 else greatest(greatest(32, least(128, 64 + 16 * way)), greatest(8, least(256, 32 + 4 * way))) end as integer) as batch,
           case when p95 < 50 then 'green' when p95 < 150 then 'yellow' else 'red' end as colour from s""")
def tuning(t):
    m = measures.percentiles(t.events, ["user_id"], "value", [95]).join(measures.rates(t.events.withColumn("is_error", F.col("event_type") == "error"), ["user_id"]), "user_id")
    m = m.withColumn("decision", measures.tuned(F.col("p95"), F.col("error_percent"), F.col("n"), target=100.0, most_errors=30.0, warm=5))
    sizes = measures.tuned_sizes(F.col("decision"), F.lit(32), F.lit(64), step=4, batch_step=16, bounds=(8, 256), batch_bounds=(32, 128))
    return m.select("user_id", measures.suggested_concurrency(F.lit(32), F.col("p95"), 100.0, 8, 256).alias("concurrency"), "decision", sizes["inflight"].alias("inflight"), sizes["batch"].alias("batch"), S.colour(F.col("p95"), 50, 150).alias("colour"))


# --- labels ----------------------------------------------------------------------------------------------------------


@query("label_names", f"""
    select file_pk, array_to_string(list_transform(labels, lambda i: coalesce((select r_name from region where r_regionkey = i), 'label_' || i)), ',') as names from {PREDICTIONS}
    """.replace("list_transform(labels, lambda i: coalesce((select r_name from region where r_regionkey = i), 'label_' || i))", "list_transform(labels, lambda i: coalesce(m[i], 'label_' || i))").replace("from (select doc_id", "from (select map_from_entries(list((r_regionkey, r_name))) as m from region) v, (select doc_id"))
def label_names(t):
    return labels.named(t.predictions(), t.vocabulary()).select("file_pk", F.array_join("names", ",").alias("names"))


@query("label_ids", f"select file_pk, array_to_string(list_sort(list_filter(labels, lambda i: i between 0 and 4)), ',') as labels from {PREDICTIONS}")
def label_ids(t):
    return labels.ids_of(labels.named(t.predictions(), t.vocabulary()), t.vocabulary()).select("file_pk", F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"))


@query("label_exclusion", f"select file_pk from {PREDICTIONS} where not list_has_any(labels, [3, 6])")
def label_exclusion(t):
    return labels.without_labels(t.predictions(), [3, 6]).select("file_pk")


@query("label_distribution", f"select name, count(*) as n from (select unnest(labels) as name from {PREDICTIONS}) group by 1")
def label_distribution(t):
    return labels.distribution(t.predictions(), "labels")


@query("label_totals", f"select count(*) as images, avg(len(labels)) as mean_labels, (select count(distinct x) from (select unnest(labels) as x from {PREDICTIONS})) as classes from {PREDICTIONS}")
def label_totals(t):
    return labels.distribution_totals(t.predictions(), "labels")


@query("thresholded", """
    select vec_id, array_to_string(list_transform(list_sort(list_filter(list_transform(range(1, 6), lambda i: {'q': -embedding[i], 'i': i}), lambda x: -x.q >= 0.05)), lambda x: chr(cast(96 + x.i as integer))), '') as found from embeddings""")
def thresholded(t):
    found = labels.above(F.slice("embedding", 1, 5), list("abcde"), 0.05)
    return t.embeddings.select("vec_id", F.array_join(F.transform(found, lambda x: x["name"]), "").alias("found"))


PER_LABEL = f"""select label, count(*) filter (truth and predicted) as tp, count(*) filter (not truth and predicted) as fp, count(*) filter (truth and not predicted) as fn,
    count(*) filter (truth) as support from {TRUTH} group by 1"""


@query("per_label_metrics", f"""
    select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
           case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1 from ({PER_LABEL}) where support > 0""")
def per_label_metrics(t):
    return labels.per_label(t.truth())


@query("multilabel_metrics", f"""
    with c as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r,
                      case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f from ({PER_LABEL})),
    s as (select sample, min(cast(truth = predicted as integer)) as ok from {TRUTH} group by 1)
    select (select avg(ok) from s) as subset_accuracy, (select avg(cast(truth <> predicted as integer)) from {TRUTH}) as hamming_loss,
           avg(f) as f1_macro, 2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) as f1_micro, sum(f * support) / sum(support) as f1_weighted, avg(p) as precision_macro, avg(r) as recall_macro from c""")
def multilabel_metrics(t):
    return labels.multilabel(t.truth())


THRESHOLDS = [round(0.10 + 0.05 * k, 2) for k in range(16)]


@query("threshold_sweep", f"""
    with s as (select vec_id as sample, i - 1 as label, label % 8 = i - 1 as truth, cast(embedding[i] as double) / 2 + 0.5 as score from embeddings, range(1, 9) r(i)),
    c as (select threshold, label, count(*) filter (truth and score >= threshold) as tp, count(*) filter (not truth and score >= threshold) as fp, count(*) filter (truth and score < threshold) as fn
          from s, (select unnest({THRESHOLDS})::double as threshold) group by 1, 2)
    select threshold, round(avg(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end), 12) as f1,
           round(avg(case when tp + fp > 0 then tp / (tp + fp) else 0.0 end), 12) as precision, round(avg(case when tp + fn > 0 then tp / (tp + fn) else 0.0 end), 12) as recall from c group by 1""")
def threshold_sweep(t):
    return labels.threshold_sweep(t.scores(), THRESHOLDS)


@query("training_frame", f"""
    select p.file_pk, tasks.path, array_to_string(p.labels, ',') as labels, n.latency_ms from {PREDICTIONS.replace(") predictions", ") p")}
    join {TASKS} on tasks.file_pk = p.file_pk join {TASKS.replace(") tasks", ") n")} on n.file_pk = p.file_pk and n.status = 'done' where not list_has_any(p.labels, [6])""")
def training_frame(t):
    own = t.predictions().withColumn("run_id", F.lit(1)).withColumn("text", F.lit(None).cast("string"))
    frame = training.training_frame(own, t.tasks(), t.tasks().withColumn("run_id", F.lit(1)), t.vocabulary(), 1, [6])
    return frame.select("file_pk", "path", F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"), "latency_ms")


@query("train_split", "select doc_id, ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint % 100 < 20 as is_valid from documents")
def train_split(t):
    return training.split(t.documents.select("doc_id"), "doc_id")


# --- texts -----------------------------------------------------------------------------------------------------------


@query("text_chunks", """
    with d as (select doc_id as file_pk, text, length(text) as n from documents where length(text) > 0),
    c as (select *, unnest(range(0, greatest(cast(ceil((n - 1200) / 1000) as integer), 0) + 1)) as k from d)
    select file_pk, cast(k as integer) as chunk_id, cast(k * 1000 as integer) as char_start, cast(least(k * 1000 + 1200, n) as integer) as char_end, md5(substr(text, k * 1000 + 1, 1200)) as chunk_md5 from c""")
def text_chunks(t):
    made = texts.chunks(t.documents.withColumnRenamed("doc_id", "file_pk"), 1200, 200)
    return made.select("file_pk", "chunk_id", "char_start", "char_end", F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"))


@query("corpus_characters", "select cast(sum(length(text)) as bigint) as characters, count(*) as documents from documents")
def corpus_characters(t):
    return t.documents.agg(F.sum(F.length("text")).alias("characters"), F.count("*").alias("documents"))


@query("unembedded", "select doc_id from documents where doc_id not in (select doc_id from labels where quality = 1)")
def unembedded(t):
    done = t.labels.filter("quality = 1").withColumn("model_name", F.lit("m"))
    return texts.open_work(t.documents.select("doc_id"), done, ["doc_id"], "m")


@query("enrich_budget", """
    select doc_id as file_pk, cast(length(text) as bigint) as text_len, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) as word_count,
           length(text) > 1538 as truncated, md5(substr(text, 1, 1538)) as text_md5 from documents where length(text) > 0""")
def enrich_budget(t):
    made = texts.within_budget(t.documents.withColumnRenamed("doc_id", "file_pk"), texts.character_budget(500, 4.0, 1.3))
    return made.select("file_pk", "text_len", "word_count", "truncated", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("hashed_vectors", """
    with w as (select conv_id, turn, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\v\\f\\r]+'), lambda w: w <> '') as ws from conversations),
    p as (select conv_id, turn, list_transform(ws, lambda w: ('0x' || substr(md5(w), 1, 4))::integer % 16) as ps from w),
    c as (select conv_id, turn, list_transform(range(16), lambda k: cast(len(list_filter(ps, lambda x: x = k)) as double)) as c from p)
    select conv_id, turn, case when list_sum(c) > 0 then cast(round(c[1] / sqrt(list_dot_product(c, c)), 4) as double) else 0.0 end as x0,
           cast(list_sum(c) as bigint) > 0 as some from c""")
def hashed_vectors(t):
    v = texts.hashed_vector(F.col("text"))
    out = t.conversations.select("conv_id", "turn", v.alias("v"))
    return out.select("conv_id", "turn", F.round(F.get("v", 0).cast("double"), 4).alias("x0"), F.exists("v", lambda x: x > 0).alias("some"))


@query("reply_fields", """
    with e as (select event_id, json_extract_string(props, '$.k') as k from events)
    select event_id, case when event_id % 6 = 5 then null when event_id % 6 = 4 then null else k end as subject, case when event_id % 6 in (4, 5) then null else 's ' || event_id end as summary,
           case event_id % 6 when 0 then 'a' when 3 then 'x' end as doc_type,
           case event_id % 6 when 0 then '["e1"]' when 1 then 'null' when 2 then '{"n":1}' when 4 then '[]' end as entities_json,
           case event_id % 6 when 0 then '["a","b"]' when 1 then '[1,"b"]' when 2 then '"x"' when 3 then '["x"]' when 4 then '[]' end as tags_json
    from e""")
def reply_fields(t):
    """Replies with lists, lists that begin with a number, a text in place of a list, missing keys, a subject that is no
    text, and what is no object; one in three in a code fence."""
    head = F.concat(F.lit('{"subject":"'), F.get_json_object("props", "$.k"), F.lit('","summary":"s '), F.col("event_id").cast("string"), F.lit('"'))
    tail = [',"tags":["a","b"],"entities":["e1"]}', ',"tags":[1,"b"],"entities":null}', ',"tags":"x","entities":{"n":1}}', ',"tags":["x"]}']
    made = F.element_at(F.array(*(F.concat(head, F.lit(x)) for x in tail), F.lit('{"subject":7,"tags":[],"entities":[]}'), F.lit('["no object"]')), (F.col("event_id") % 6 + 1).cast("int"))
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), made, F.lit("\n```"))).otherwise(made)
    return t.events.select("event_id", texts.parsed_reply(raw).alias("p")).select("event_id", "p.*")


@query("checked_labels", """
    select event_id, case when event_id % 5 = 0 then null when event_id % 7 = 3 then null else array_to_string(list_sort(list_distinct([event_id % 7, 1])), ',') end as labels,
           case when event_id % 5 = 0 then 'labels must be a list of integers' when event_id % 7 = 3 then 'uncertain_label_ids=[3]' end as error from events""")
def checked_labels(t):
    raw = F.when(F.col("event_id") % 5 == 0, F.lit('{"labels":["x"]}')).otherwise(F.format_string('{"labels": [%d, 1, 1]}', F.col("event_id") % 7))
    made = labels.checked_labels(raw, [3])
    return t.events.select("event_id", F.array_join(made["labels"].cast("array<string>"), ",").alias("labels"), made["error"].alias("error"))


@query("retry_backoff", "select event_id, least(0.5 * pow(2.0, event_id % 9 - 1), 30.0) as seconds from events")
def retry_backoff(t):
    return t.events.select("event_id", S.backoff_seconds(F.col("event_id") % 9, 0.5, 2.0, 30.0).alias("seconds"))


# --- paths -----------------------------------------------------------------------------------------------------------


@query("output_paths", """
    select doc_id, printf('deriv/b%06d/%06d_%012d.jpg', cast(doc_id // 100 as integer), cast(doc_id % 100 as integer), doc_id) as path from documents""")
def output_paths(t):
    d = F.col("doc_id")
    return t.documents.select("doc_id", S.output_path("deriv", F.expr("doc_id div 100"), d % 100, d, F.lit(".jpg")).alias("path"))


@query("file_kinds", """
    select doc_id, case doc_id % 4 when 0 then 'images' when 1 then 'pdfs' when 2 then 'docs' else 'other' end as kind, doc_id % 4 = 3 as archive from documents""")
def file_kinds(t):
    path = F.concat(F.lit("dir.x/f"), F.col("doc_id").cast("string"), F.get(F.array(F.lit(".JPG"), F.lit(".pdf"), F.lit(".docx"), F.lit(".tar.gz")), (F.col("doc_id") % 4).cast("int")))
    return t.documents.select("doc_id", S.file_kind(path).alias("kind"), S.is_archive(path).alias("archive"))


@query("output_formats", """
    select doc_id, case when doc_id % 2 = 0 then 'png' else 'jpeg' end as format, case when doc_id % 2 = 0 then '.PNG' else '.jpg' end as suffix from documents""")
def output_formats(t):
    path = F.concat(F.lit("a/b"), F.when(F.col("doc_id") % 2 == 0, ".PNG").otherwise(".pdf"))
    made = S.output_format(path, F.lit("jpeg"), True)
    return t.documents.select("doc_id", made["format"].alias("format"), made["suffix"].alias("suffix"))


@query("download_names", """
    select page_id, coalesce(nullif(regexp_extract(regexp_replace(split_part(url, '?', 1), '/+$', ''), '([^/]*)$', 1), ''), 'download.bin') || '__' || substr(sha1(url), 1, 10) as name from pages""")
def download_names(t):
    return t.pages.select("page_id", S.download_name(F.col("url")).alias("name"))


@query("safe_paths", "select doc_id, case when doc_id % 3 = 0 then 'x/' || doc_id end as rel from documents")
def safe_paths(t):
    path = F.concat(F.get(F.array(F.lit("/data/x/"), F.lit("/data/../x/"), F.lit("/other/x/")), (F.col("doc_id") % 3).cast("int")), F.col("doc_id").cast("string"))
    return t.documents.select("doc_id", S.safe_relative("/data", path).alias("rel"))


@query("collision_suffixes", "select doc_id, '__' || substr(sha1(source || '|' || doc_id), 1, 10) as ending from documents")
def collision_suffixes(t):
    return t.documents.select("doc_id", S.collision_suffix(F.col("source"), F.col("doc_id").cast("string")).alias("ending"))


@query("rectangles", """
    select event_id, cast(event_id % 5 as double) as x0, cast(event_id % 7 as double) as y0, cast(event_id % 5 + 10 as double) as x1, cast(event_id % 7 + 20 as double) as y1 from events""")
def rectangles(t):
    x, y = F.col("event_id") % 5, F.col("event_id") % 7
    box = S.rectangle(F.format_string("[%d,%d,%d,%d,%d,%d,%d,%d]", x, y, x + 10, y, x + 10, y + 20, x, y + 20))
    return t.events.select("event_id", *(F.get(box, k).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


# --- layout ----------------------------------------------------------------------------------------------------------

RELATIONS = f"""(select a.page, a.block as a, b.block as b, abs(b.y - a.y) < 20 as same_row, abs(b.x - a.x) < 50 as same_column,
    sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) as gap, greatest(a.w, a.h) as side, b.x - a.x as dx, b.y - a.y as dy
    from {BLOCKS.replace(") blocks", ") a")} join {BLOCKS.replace(") blocks", ") b")} on a.page = b.page and a.block < b.block) p"""
KIND = "case when gap < 2 * side then 'near' when same_column then case when dy > 0 then 'above' else 'below' end when same_row then case when dx > 0 then 'left_of' else 'right_of' end end"


@query("layout_relations", f"select page, a, b, {KIND} as relation, case when gap < 2 * side then 1 / greatest(gap, 1.0) else 1.0 end as weight from {RELATIONS} where {KIND} is not null")
def layout_relations(t):
    return layout.block_relations(t.blocks(), 20.0, 50.0).select("page", "a", "b", "relation", "weight")


@query("reading_order", f"select page, block, cast(row_number() over (partition by page order by cast(trunc(y / 20) as integer), x, block) - 1 as integer) as place from {BLOCKS}")
def reading_order(t):
    return layout.reading_order(t.blocks(), 20.0)


@query("layout_regions", f"""
    with recursive e as (select page, a, b from {RELATIONS} where {KIND} is not null), s as (select page, a, b from e union all select page, b, a from e),
    reach(page, node, other) as (select page, a, a from s union select r.page, r.node, s.b from reach r join s on s.page = r.page and s.a = r.other)
    select page, node as block, min(other) as region from reach group by 1, 2""")
def layout_regions(t):
    return layout.block_regions(t.blocks(), 20.0, 50.0, kept)


@query("layout_tables", f"""
    with recursive e as (select page, a, b from {RELATIONS} where same_row), s as (select page, a, b from e union all select page, b, a from e),
    reach(page, node, other) as (select page, a, a from s union select r.page, r.node, s.b from reach r join s on s.page = r.page and s.a = r.other),
    g as (select page, node as block, min(other) as region from reach group by 1, 2)
    select page, region, count(*) as n_blocks, count(distinct cast(trunc(y / 20) as integer)) as n_rows from g join {BLOCKS} using (page, block) group by 1, 2 having n_rows >= 2 and n_blocks >= 2""")
def layout_tables(t):
    return layout.tables(t.blocks(), None, 20.0, kept)


@query("layout_summary", f"""
    with r as (select page, {KIND} as k from {RELATIONS}), n as (select page, count(k) as n_relations, count(*) filter (k = 'near') as n_near, count(*) filter (k = 'above') as n_above,
        count(*) filter (k = 'below') as n_below, count(*) filter (k = 'left_of') as n_left_of, count(*) filter (k = 'right_of') as n_right_of from r group by 1)
    select b.page, n_blocks, coalesce(n_relations, 0) as n_relations, coalesce(n_near, 0) as n_near, coalesce(n_above, 0) as n_above, coalesce(n_below, 0) as n_below,
           coalesce(n_left_of, 0) as n_left_of, coalesce(n_right_of, 0) as n_right_of from (select page, count(*) as n_blocks from {BLOCKS} group by 1) b left join n on n.page = b.page""")
def layout_summary(t):
    return layout.summary(t.blocks(), layout.block_relations(t.blocks(), 20.0, 50.0))


# --- entities --------------------------------------------------------------------------------------------------------


@query("entity_contains", f"select image, entity, arg_max(confidence, (pos, confidence)) as confidence, count(*) as n from {MENTIONS} group by 1, 2")
def entity_contains(t):
    return entities.contains(t.mentions())


@query("entity_nodes", f"select entity, arg_min(type, (image, pos, type)) as type, max(confidence) as confidence, count(distinct image) as images from {MENTIONS} group by 1")
def entity_nodes(t):
    return entities.entity_nodes(t.mentions())


PAIRS = f"select a.entity as a, b.entity as b, count(*) as weight, min(a.image) as first_image from {MENTIONS.replace(') mentions', ') a')} join {MENTIONS.replace(') mentions', ') b')} on a.image = b.image and a.pos < b.pos group by 1, 2"


@query("entity_pairs", PAIRS)
def entity_pairs(t):
    return entities.co_occurrences(t.mentions())


@query("similar_images", f"""
    with s as (select distinct image, entity from {MENTIONS}), o as (select entity from s where image = 1), n as (select image, count(*) as size from s group by 1)
    select image, count(*) as shared, round(count(*) / (any_value(size) + (select count(*) from o) - count(*)), 4) as jaccard
    from s join o using (entity) join n using (image) where image <> 1 group by 1 order by jaccard desc, image limit 10""")
def similar_images(t):
    return entities.similar_images(t.mentions(), 1)


@query("entity_connections", f"""
    with e as ({PAIRS}) select b as other, 'out' as direction, cast(weight as double) as weight from e where a = 10 union all select a, 'in', cast(weight as double) from e where b = 10""")
def entity_connections(t):
    return entities.connections(entities.co_occurrences(t.mentions()), 10)


@query("entity_co_occurring", f"with e as ({PAIRS}) select b as entity, weight from e where a = 10 and weight >= 1 order by weight desc, b limit 20")
def entity_co_occurring(t):
    return entities.co_occurring(entities.co_occurrences(t.mentions()), 10)


@query("entity_images", f"select distinct image from {MENTIONS} where entity = 10")
def entity_images(t):
    return entities.images_of(t.mentions(), 10)


@query("entity_frequency", f"select entity, count(distinct image) as images from {MENTIONS} group by 1 order by images desc, entity limit 20")
def entity_frequency(t):
    return entities.frequent(t.mentions(), 20)


@query("graph_statistics", f"""
    with m as (select * from {MENTIONS}), v as (select count(distinct image) as images, count(distinct entity) as entities from m), h as (select count(*) as held from (select distinct image, entity from m)),
    p as (select count(*) as paired from ({PAIRS})), c as (select count(distinct n_name) as concepts, count(*) as is_a from nation)
    select images + entities + concepts as nodes, held + paired + is_a as edges, images, entities, concepts from v, h, p, c""")
def graph_statistics(t):
    return entities.statistics(t.mentions(), t.concepts())


@query("concept_hierarchy", """
    select n_name as name, r_name as parent, '' as children from nation join region on n_regionkey = r_regionkey
    union all select r_name, null, string_agg(n_name, ',' order by n_name) from nation join region on n_regionkey = r_regionkey group by r_name""")
def concept_hierarchy(t):
    return entities.hierarchy(t.concepts()).select("name", "parent", F.array_join("children", ",").alias("children"))


@query("event_windows", "select date_trunc('hour', ts) as window_start, event_type, count(*) as n from events group by 1, 2")
def event_windows(t):
    from ..streaming.ingest import windowed_counts

    return windowed_counts(t.events)


# --- lookups ---------------------------------------------------------------------------------------------------------


def _paths(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("file_pk"), F.concat(F.lit("dir/"), "source", F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".tar.gz")).alias("path"))


@query("file_page", "select doc_id from documents where doc_id > 20 order by doc_id limit 64")
def file_page(t):
    return lookups.page_after(t.documents.select("doc_id"), "doc_id", 20, 64)


@query("truth_rows", """
    select doc_id as file_pk, 'dir/' || source || '/d' || doc_id || '.tar.gz' as path, quality || ',' || (toxic + 2) as labels
    from labels join documents using (doc_id) where doc_id % 2 = 0""")
def truth_rows(t):
    own = t.labels.select(F.col("doc_id").alias("file_pk"), (F.col("doc_id") % 2).alias("run_id"), F.array("quality", F.col("toxic") + 2).alias("labels"))
    return lookups.truth_rows(own, _paths(t), 0).select("file_pk", "path", F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"))


@query("files_with_tasks", "select doc_id as file_pk from documents where doc_id in (select user_id from events where event_type = 'error')")
def files_with_tasks(t):
    own = t.events.select(F.col("user_id").alias("file_pk"), F.col("event_type").alias("run_id"))
    return lookups.files_with_tasks(t.documents.select(F.col("doc_id").alias("file_pk")), own, "error")


@query("label_rows", """
    select doc_id as file_pk, 'dir/' || source || '/d' || doc_id || '.tar.gz' as path, toxic as run_id from labels join documents using (doc_id) order by doc_id, toxic limit 100""")
def label_rows(t):
    own = t.labels.select(F.col("doc_id").alias("file_pk"), F.col("toxic").alias("run_id"), F.array("quality").alias("labels"), F.lit("x").alias("text"))
    return lookups.label_rows(own, _paths(t), most=100).select("file_pk", "path", "run_id")


@query("keys_of_paths", "select doc_id as file_pk, 'dir/' || source || '/d' || doc_id || '.tar.gz' as path from documents where doc_id % 3 = 0")
def keys_of_paths(t):
    asked = _paths(t).filter("file_pk % 3 = 0").select("path").unionByName(t.documents.select(F.concat(F.lit("none/"), "source").alias("path")))
    return lookups.keys_of_paths(asked, _paths(t)).select("file_pk", "path")


@query("keys_of_stems", "select doc_id as file_pk, 'd' || doc_id || '.tar' as stem from documents where doc_id % 3 = 0")
def keys_of_stems(t):
    asked = t.documents.select(F.concat(F.when(F.col("doc_id") % 3 == 0, "d").otherwise("none"), F.col("doc_id").cast("string"), F.lit(".tar")).alias("stem"))
    return lookups.keys_of_stems(asked, _paths(t)).select("file_pk", "stem")


@query("evaluated_run", """
    with b as (select doc_id, [quality, toxic + 2] as t, [toxic, quality + 2] as p from labels where doc_id % 5 <> 0),
    c as (select r_regionkey as label, count(*) filter (list_contains(t, r_regionkey) and list_contains(p, r_regionkey)) as tp,
                 count(*) filter (not list_contains(t, r_regionkey) and list_contains(p, r_regionkey)) as fp,
                 count(*) filter (list_contains(t, r_regionkey) and not list_contains(p, r_regionkey)) as fn, count(*) filter (list_contains(t, r_regionkey)) as support from b, region group by 1)
    select label, tp, fp, fn, support, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
           case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1 from c where support > 0""")
def evaluated_run(t):
    truth = t.labels.select(F.col("doc_id").alias("file_pk"), F.array("quality", F.col("toxic") + 2).alias("labels"))
    made = t.labels.filter("doc_id % 5 <> 0").select(F.col("doc_id").alias("file_pk"), F.array("toxic", F.col("quality") + 2).alias("labels"))
    return labels.per_label(lookups.evaluated_run(made, truth, t.vocabulary()))


@query("dashboard_totals", f"""
    with f as (select file_pk, file_pk <> min(file_pk) over (partition by content_hash) as dupe from {FILES}),
    p as (select doc_id, quality = 1 as told from labels)
    select (select count(*) from f) as files, (select count(*) from f) as hashed, (select count(*) from f where file_pk % 10 = 0) as pending, (select count(*) from f where not dupe) as uniques,
           (select count(*) from f where dupe) as dupes, (select count(*) from f where file_pk % 7 = 0) as near_dupes, (select count(*) from p) as labelled,
           (select count(*) from p where told and doc_id not in (select vec_id from embeddings)) as unembedded, (select count(*) from p where told and doc_id not in (select conv_id from conversations)) as enrichable""")
def dashboard_totals(t):
    rows = catalog.exact_duplicates(t.files()).withColumn("status", (F.col("file_pk") % 10 != 0).cast("int")).withColumn("near_of", F.when(F.col("file_pk") % 7 == 0, 1))
    own = t.labels.select(F.col("doc_id").alias("file_pk"), F.when(F.col("quality") == 1, "x").alias("text"))
    return lookups.totals(rows, own, t.embeddings.select(F.col("vec_id").alias("file_pk")), t.conversations.select(F.col("conv_id").alias("file_pk")))


@query("ingest_counters", """
    select kind, count(*) filter (event_id is not null and event_type <> 'error') as ok, count(*) filter (event_type = 'error') as errors
    from (values ('download'), ('unarchive'), ('sort')) k(kind) left join events on kind = case event_id % 2 when 0 then 'download' else 'sort' end group by 1""")
def ingest_counters(t):
    return lookups.ingest_counters(t.events.select(F.when(F.col("event_id") % 2 == 0, "download").otherwise("sort").alias("kind"), F.when(F.col("event_type") == "error", "boom").alias("error")))


@query("reply_checks", """
    select event_id, case event_id % 5 when 0 then 't' end as subject, case event_id % 5 when 0 then null when 4 then 'subject must be a text' else 'subject is required' end as subject_error,
           case event_id % 5 when 0 then 'a,b' when 1 then '' end as entities, case event_id % 5 when 2 then 'entities must be a list of texts' when 4 then 'entities must be a list of texts' end as entities_error from events""")
def reply_checks(t):
    replies = ['{"subject":" t ","entities":["a","b"]}', '{"subject":"","entities":[]}', '{"entities":["a",1]}', '{"subject":null}', '{"subject":[1],"entities":"a"}']
    raw = F.element_at(F.array(*map(F.lit, replies)), (F.col("event_id") % 5 + 1).cast("int"))
    a, b = lookups.text_field(raw, "subject", required=True), lookups.list_field(raw, "entities", required=False)
    return t.events.select("event_id", a["value"].alias("subject"), a["error"].alias("subject_error"), F.array_join(b["value"], ",").alias("entities"), b["error"].alias("entities_error"))


@query("claims_rebuilt", f"select content_hash, min(file_pk) as canonical_file_pk from (select * from {FILES}) group by 1")
def claims_rebuilt(t):
    own = t.files().groupBy("content_hash").agg(F.min("file_pk").alias("canonical_file_pk"))
    claims = own.filter("canonical_file_pk % 13 <> 0").select(F.concat("content_hash", F.when(F.col("canonical_file_pk") % 11 == 0, "x").otherwise("")).alias("content_hash"), "canonical_file_pk")
    return catalog.rebuilt_claims(claims, t.files())


@query("bucket_more", """
    with o as (select doc_id as file_pk, case when doc_id % 4 = 0 then doc_id // 4 end as ok_index from documents), top as (select max(ok_index) + 1 as top from o),
    i as (select file_pk, coalesce(ok_index, top + row_number() over (partition by ok_index is null order by file_pk) - 1) as ok_index from o, top)
    select file_pk, ok_index, ok_index // 100 as bucket_id, ok_index % 100 as bucket_pos from i""")
def bucket_more(t):
    rows = t.documents.select(F.col("doc_id").alias("file_pk"), F.when(F.col("doc_id") % 4 == 0, F.expr("doc_id div 4")).alias("ok_index"))
    return catalog.bucketed(rows, 100).select("file_pk", "ok_index", "bucket_id", "bucket_pos")


@query("smoothed_p95", """
    with recursive o as (select user_id, event_id, value as v, row_number() over (partition by user_id order by ts, event_id) as i from events),
    f as (select user_id, event_id, i, v as m from o where i = 1 union all select o.user_id, o.event_id, o.i, m + (v - m) / 3 from f join o on o.user_id = f.user_id and o.i = f.i + 1)
    select event_id, round(m, 6) as ema from f""")
def smoothed_p95(t):
    return measures.smoothed(t.events, ["user_id"], ["ts", "event_id"], "value", 1 / 3).select("event_id", F.round("ema", 6).alias("ema"))


@query("cool_downs", """
    with recursive o as (select user_id, event_id, case event_type when 'error' then 'scale_down' when 'click' then 'scale_up' else 'hold' end as d, row_number() over (partition by user_id order by event_id) as i from events),
    f as (select user_id, event_id, i, case when d <> 'hold' then 3 else 0 end as rest, d as decision from o where i = 1
          union all select o.user_id, o.event_id, o.i, case when d <> 'hold' and rest <= 0 then 3 else greatest(rest - 1, 0) end, case when d <> 'hold' and rest > 0 then 'cooldown' else d end
          from f join o on o.user_id = f.user_id and o.i = f.i + 1)
    select user_id, event_id, decision from f""")
def cool_downs(t):
    d = F.when(F.col("event_type") == "error", "scale_down").when(F.col("event_type") == "click", "scale_up").otherwise("hold")
    return measures.with_cool_down(t.events.withColumn("decision", d), ["user_id"], "event_id", 3)


@query("concept_instances", "select distinct l_partkey as a, l_shipmode_ as b, 'instance_of' as relation, cast(1 as double) as weight from (select l_partkey, l_returnflag as l_shipmode_ from lineitem)")
def concept_instances(t):
    return entities.instances(t.lineitem.select(F.col("l_partkey").alias("entity"), F.col("l_returnflag").alias("concept")))


# --- derivatives and runs --------------------------------------------------------------------------------------------

DERIVATIVES = """(select max(o_orderkey) as deriv_pk, o_custkey as file_pk, o_orderpriority as preset, cast(max(o_orderkey) % 3 as integer) as status from orders group by 2, 3)"""


def _derivatives(t: Tables) -> DataFrame:
    """The largest order of a customer and a priority as a derivative."""
    own = t.orders.groupBy(F.col("o_custkey").alias("file_pk"), F.col("o_orderpriority").alias("preset")).agg(F.max("o_orderkey").alias("deriv_pk"))
    return own.withColumn("transform_cfg_id", F.lit(0)).withColumn("status", (F.col("deriv_pk") % 3).cast("int")).withColumn("error", F.when(F.col("status") == 2, "old"))


def _wanted(t: Tables) -> DataFrame:
    names = F.array(F.lit("1-URGENT"), F.lit("9-NEW"))
    return t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("file_pk"), F.explode(names).alias("preset"), F.lit(0).alias("transform_cfg_id"))


def _marked(status: str, error: str) -> str:
    return f"""
    with o as (from {DERIVATIVES}), w as (select c_custkey as file_pk, preset from customer, (values ('1-URGENT'), ('9-NEW')) v(preset) where c_custkey % 3 = 0),
    j as (select file_pk, preset, o.deriv_pk, o.status, w.file_pk is not null as hit from o full join w using (file_pk, preset)),
    n as (select *, row_number() over (partition by deriv_pk is null order by file_pk, preset) as n from j)
    select coalesce(deriv_pk, n + (select max(deriv_pk) from o)) as deriv_pk, file_pk, preset, cast(case when hit then {status} else status end as integer) as status,
           case when hit then {error} when status = 2 then 'old' end as error from n"""


@query("derivatives_pending", _marked("0", "null"))
def derivatives_pending(t):
    return derivatives.pending(_derivatives(t), _wanted(t)).select("deriv_pk", "file_pk", "preset", "status", "error")


@query("derivatives_failed", _marked("2", "'broken ' || preset"))
def derivatives_failed(t):
    return derivatives.failed(_derivatives(t), _wanted(t), F.concat(F.lit("broken "), "preset")).select("deriv_pk", "file_pk", "preset", "status", "error")


@query("derivative_results", f"""
    select deriv_pk, cast(case when deriv_pk % 2 = 1 then status when deriv_pk % 4 = 0 then 1 else 2 end as integer) as status,
           case when deriv_pk % 2 = 1 then case when status = 2 then 'old' end when deriv_pk % 4 <> 0 then 'full' end as error from {DERIVATIVES}""")
def derivative_results(t):
    ok = F.col("o_orderkey") % 4 == 0
    results = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("deriv_pk"), ok.alias("ok"), F.when(~ok, "full").alias("error"))
    return derivatives.after_results(_derivatives(t), results).select("deriv_pk", "status", "error")


@query("open_transforms", """
    select c_custkey as file_pk, cfg as transform_cfg_id from customer, (values (0), (1)) v(cfg)
    where not exists (select 1 from orders where o_custkey = c_custkey and o_orderkey % 3 = 1 and o_orderkey % 2 = cfg)""")
def open_transforms(t):
    runs = t.orders.select(F.col("o_custkey").alias("file_pk"), (F.col("o_orderkey") % 2).cast("int").alias("transform_cfg_id"), (F.col("o_orderkey") % 3).alias("status"))
    return derivatives.open_transforms(t.customer.select(F.col("c_custkey").alias("file_pk"), F.explode(F.array(F.lit(0), F.lit(1))).alias("transform_cfg_id")), runs)


@query("transforms_after", """
    with o as (select max(o_orderkey) as run_id, o_custkey as file_pk from orders group by 2), top as (select max(run_id) as top from o),
    j as (select file_pk, run_id, c_custkey is not null as hit from o full join (select c_custkey, c_custkey as file_pk from customer where c_custkey % 2 = 0) using (file_pk)),
    n as (select *, row_number() over (partition by run_id is null order by file_pk) as n from j)
    select coalesce(run_id, n + top) as run_id, file_pk, cast(case when hit then 1 else 2 end as integer) as status from n, top""")
def transforms_after(t):
    runs = t.orders.groupBy(F.col("o_custkey").alias("file_pk")).agg(F.max("o_orderkey").alias("run_id")).withColumn("transform_cfg_id", F.lit(0)).withColumn("status", F.lit(2))
    made = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("file_pk"), F.lit(0).alias("transform_cfg_id"), F.lit(1).alias("status"))
    return derivatives.after_transforms(runs, made).select("run_id", "file_pk", "status")


@query("chunked_run", """
    with p as (select doc_id // 2 as file_pk, arg_max(text, doc_id) as text from documents where length(text) > 0 group by 1),
    c as (select *, unnest(range(0, greatest(cast(ceil((length(text) - 1200) / 1000) as integer), 0) + 1)) as k from p)
    select file_pk, cast(k as integer) as chunk_id, md5(substr(text, k * 1000 + 1, 1200)) as chunk_md5 from c
    union all select vec_id, 0, md5('old') from embeddings where vec_id not in (select file_pk from p)""")
def chunked_run(t):
    old = t.embeddings.select(F.col("vec_id").alias("file_pk"), F.lit(0).alias("chunk_id"), F.lit(0).alias("char_start"), F.lit(3).alias("char_end"), F.lit("old").alias("chunk"))
    own = t.documents.select(F.expr("doc_id div 2").alias("file_pk"), (F.col("doc_id") % 2).alias("run_id"), F.col("doc_id").alias("created_at"), "text")
    made, _ = texts.chunked_run(old, own, 1200, 200)
    return made.select("file_pk", "chunk_id", F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"))


@query("run_documents", "select count(*) as documents from documents where doc_id % 2 = 1 and length(text) > 0")
def run_documents(t):
    own = t.documents.select(F.expr("doc_id div 2").alias("file_pk"), (F.col("doc_id") % 2).alias("run_id"), F.col("doc_id").alias("created_at"), "text")
    return texts.chunked_run(own.select("file_pk", F.lit(0).alias("chunk_id"), F.lit(0).alias("char_start"), F.lit(0).alias("char_end"), F.col("text").alias("chunk")), own, 1200, 200, run_id=1)[1]


def _predicted(t: Tables) -> tuple[DataFrame, DataFrame]:
    own = t.labels.select(F.col("doc_id").alias("file_pk"), F.col("toxic").alias("run_id"), F.array("quality").alias("labels"), F.lit("old").alias("text"))
    work = t.labels.select(F.col("doc_id").alias("file_pk"), F.col("toxic").alias("run_id"), F.lit("pending").alias("status"))
    made = t.documents.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("file_pk"), F.array(F.lit(7).cast(t.labels.schema["quality"].dataType)).alias("labels"))
    return training.after_predictions(own, work, made, 0)


@query("predictions_after", """
    select doc_id as file_pk, 0 as run_id, 7 as label, null as text from documents where doc_id % 3 = 0
    union all select doc_id, toxic, quality, 'old' from labels where toxic = 1 or doc_id % 3 <> 0 or doc_id not in (select doc_id from documents)""")
def predictions_after(t):
    return _predicted(t)[0].select("file_pk", "run_id", F.get("labels", 0).alias("label"), "text")


@query("tasks_predicted", """
    select doc_id as file_pk, toxic as run_id, case when toxic = 0 and doc_id % 3 = 0 and doc_id in (select doc_id from documents) then 'done' else 'pending' end as status from labels""")
def tasks_predicted(t):
    return _predicted(t)[1]


@query("files_to_predict", "select doc_id as file_pk from documents where doc_id in (select user_id from events where event_type = 'click')")
def files_to_predict(t):
    own = t.events.select(F.col("user_id").alias("file_pk"), F.col("event_type").alias("run_id"))
    return training.files_to_predict(t.documents.select(F.col("doc_id").alias("file_pk")), own, "view", "click")


@query("path_bytes", "select doc_id, lower(hex(encode('dir é/' || source || '/' || doc_id))) as bytes, 'dir é/' || source || '/' || doc_id as path from documents")
def path_bytes(t):
    data = S.path_bytes(F.concat(F.lit("dir é/"), "source", F.lit("/"), F.col("doc_id").cast("string")))
    return t.documents.select("doc_id", F.lower(F.hex(data)).alias("bytes"), S.path_text(data).alias("path"))


@query("free_targets", """
    with r as (select doc_id, source || '/f' || (doc_id % 50) || '.txt' as rel from documents)
    select doc_id, case when doc_id % 50 = 7 or doc_id > min(doc_id) over (partition by rel)
                        then left(rel, length(rel) - 4) || '__' || substr(sha1(rel || '|' || doc_id), 1, 10) || '.txt' else rel end as target from r""")
def free_targets(t):
    rows = t.documents.select("doc_id", F.format_string("%s/f%d.txt", F.col("source"), F.col("doc_id") % 50).alias("rel"), F.col("doc_id").cast("string").alias("hint"))
    return lookups.free_targets(rows, rows.filter("doc_id % 50 = 7"), "doc_id").select("doc_id", "target")


@query("scan_capped", f"""
    with l as (select * from (select * from {LISTING} order by path limit 150) where path like '%1'), c as (select * from {CATALOG}), top as (select max(file_pk) as top from c)
    select coalesce(file_pk, top + row_number() over (partition by file_pk is null order by path)) as file_pk, path, coalesce(l.size, c.size) as size from l full join c using (path), top""")
def scan_capped(t):
    # paths get an ending for the scan, and lose it again
    named = lambda rows: rows.withColumn("path", F.concat("path", F.lit("."), F.right("path", F.lit(1))))
    made = catalog.merged_catalog(named(_listing(t)), named(_catalog(t)), suffixes=[".1"], most=150)
    return made.select("file_pk", F.expr("left(path, length(path) - 2)").alias("path"), "size")
