"""Registries, coverage, gates, merges and other queries over rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import quantities as Q
from geoloom.functions import text as TX
from geoloom.operators import aggregates as A
from geoloom.operators import gates as GA
from geoloom.operators import joins as J
from geoloom.sources import files as S

from .registry import FOLD, ORDER, ROUND1, query, table

ORD = ", ".join(ORDER)


def pct1_sql(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN {ROUND1.format(f'({a})::DOUBLE * 100 / ({b})')} ELSE 0.0 END"


# ---------------------------------------------------------------- look-ups


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS code FROM events)
SELECT user_id, arg_min(code, event_id) FILTER (code IS NOT NULL AND code <> '') AS code FROM e GROUP BY user_id""")
def first_nonempty_lookup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("code"))
    return J.first_value(e, "user_id", "code", "event_id")


@query("""WITH e AS (SELECT user_id, arg_min(event_type, event_id) FILTER (event_type <> 'view') AS code FROM events WHERE user_id % 4 <> 0 GROUP BY user_id)
SELECT c_custkey, e.code AS code_zone, e.user_id IS NOT NULL AS matched FROM customer LEFT JOIN e ON user_id = c_custkey % 200""")
def enrich_lots(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("user_id % 4 <> 0").select("user_id", "event_id", F.nullif("event_type", F.lit("view")).alias("code_zone"))
    look = J.first_value(e, "user_id", "code_zone", "event_id")
    return J.left_lookup(table(spark, sf_dir, "customer").select("c_custkey"), look, F.col("c_custkey") % 200, "user_id", ["code_zone"])


@query(f"""WITH p AS (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0), l AS (SELECT l_returnflag, l_partkey IN (SELECT p_partkey FROM p) AS matched FROM lineitem)
SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (matched) AS n_matched, count(*) FILTER (NOT matched) AS n_unmatched, {pct1_sql('count(*) FILTER (matched)', 'count(*)')} AS coverage_pct FROM l GROUP BY l_returnflag""")
def join_stats(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select("p_partkey")
    both = J.left_lookup(table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag"), p, F.col("l_partkey"), "p_partkey", [])
    return J.join_stats(both, "l_returnflag")


@query("""WITH s AS (SELECT s_suppkey, s_name, s_nationkey, 'N' || s_suppkey % 31 AS nm FROM supplier), n AS (SELECT n_nationkey, 'N' || n_nationkey AS nm FROM nation),
a AS (SELECT s_suppkey, 7 AS nk FROM s WHERE s_suppkey % 11 = 0), b AS (SELECT s_suppkey, n_nationkey AS nk FROM s JOIN n ON n.nm = s.nm AND n_nationkey = s_nationkey), c AS (SELECT s_suppkey, n_nationkey AS nk FROM s JOIN n ON n.nm = s.nm)
SELECT s.s_suppkey, coalesce(a.nk, b.nk, c.nk) AS nk, CASE WHEN a.nk IS NOT NULL THEN 'alias' WHEN b.nk IS NOT NULL THEN 'name+region' WHEN c.nk IS NOT NULL THEN 'name' ELSE 'no-match' END AS method
FROM s LEFT JOIN a USING (s_suppkey) LEFT JOIN b USING (s_suppkey) LEFT JOIN c USING (s_suppkey)""")
def ranked_name_resolution(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.concat(F.lit("N"), F.col("s_suppkey") % 31).alias("nm"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), F.concat(F.lit("N"), "n_nationkey").alias("nm"))
    alias = s.filter("s_suppkey % 11 = 0").select("s_suppkey", F.lit(7).alias("nk"))
    by_name = s.join(n, "nm")
    got = J.ranked_lookup(s, "s_suppkey", [("alias", alias), ("name+region", by_name.filter("nk = s_nationkey").select("s_suppkey", "nk")), ("name", by_name.select("s_suppkey", "nk"))], ["nk"])
    return got.select("s_suppkey", "nk", "method")


@query("""WITH r AS (SELECT replace(lower(n_name), ' ', '-') AS nm, n_nationkey AS nk FROM nation), c AS (SELECT c_custkey, n_name || '--' || c_mktsegment || '--' || c_custkey AS slug FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey, 'X' || c_custkey FROM customer WHERE c_custkey % 5 = 0)
SELECT c_custkey, r.nk FROM c LEFT JOIN r ON r.nm = replace(lower(split_part(slug, '--', 1)), ' ', '-')""")
def longest_prefix_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    slug = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("X"), "c_custkey")).otherwise(F.concat_ws("--", "n_name", "c_mktsegment", F.col("c_custkey").cast("string")))
    c = c.select("c_custkey", slug.alias("slug"))
    got = J.by_prefix(c, "c_custkey", "slug", n.select(TX.norm_name("n_name").alias("nm"), F.col("n_nationkey").alias("nk")), "nm", "nk")
    return c.select("c_custkey").join(got, "c_custkey", "left")


@query("""SELECT c_custkey, arg_min(s_suppkey, (abs(c_acctbal - s_acctbal), s_suppkey)) AS s_suppkey FROM customer JOIN supplier ON s_nationkey = c_nationkey GROUP BY c_custkey""")
def homonym_min_popdiff(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").withColumn("k", F.col("c_nationkey")), table(spark, sf_dir, "supplier").withColumn("k", F.col("s_nationkey"))
    return J.closest(c, s, "k", "c_custkey", "c_acctbal", "s_acctbal", ["s_suppkey"], "s_suppkey")


CODES = "SELECT DISTINCT p_type AS grp, regexp_replace(replace(upper(p_brand), ' ', ''), '^([A-Z]+)-?0*([0-9])', '\\1-\\2') AS code FROM part WHERE {}"


@query(f"""WITH a AS ({CODES.format('p_partkey % 3 = 0')}), b AS ({CODES.format('p_partkey % 4 = 0')}), j AS (SELECT coalesce(a.grp, b.grp) AS grp, a.code IS NOT NULL AS l, b.code IS NOT NULL AS r FROM a FULL JOIN b ON a.grp = b.grp AND a.code = b.code)
SELECT grp, count(*) FILTER (l) AS n_left, count(*) FILTER (r) AS n_right, count(*) FILTER (l AND r) AS n_both, CASE WHEN count(*) FILTER (l) > 0 THEN count(*) FILTER (l AND r)::DOUBLE / count(*) FILTER (l) ELSE 0 END AS share_left, CASE WHEN count(*) FILTER (r) > 0 THEN count(*) FILTER (l AND r)::DOUBLE / count(*) FILTER (r) ELSE 0 END AS share_right FROM j GROUP BY grp""")
def set_overlap_metrics(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("grp"), TX.canon_zone("p_brand").alias("code"))
    return J.set_overlap(p.filter("p_partkey % 3 = 0"), p.filter("p_partkey % 4 = 0"), "grp", "code")


@query("""WITH old AS (SELECT o_orderkey, o_totalprice, 'old' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'), new AS (SELECT o_orderkey, o_totalprice, 'new' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)""")
def manifest_union_if_absent(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cols = lambda w: ["o_orderkey", "o_totalprice", F.lit(w).alias("origin")]
    return J.merge_absent(o.filter("o_orderdate < '1998-06-01'").select(*cols("old")), o.filter("o_orderdate >= '1997-06-01'").select(*cols("new")), "o_orderkey")


@query("""WITH old AS (SELECT o_orderkey, o_totalprice, 'old' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'), new AS (SELECT o_orderkey, o_totalprice, 'new' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def manifest_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cols = lambda w: ["o_orderkey", "o_totalprice", F.lit(w).alias("origin")]
    return J.upsert(o.filter("o_orderdate < '1998-06-01'").select(*cols("old")), o.filter("o_orderdate >= '1997-06-01'").select(*cols("new")), "o_orderkey")


@query("""SELECT c_custkey, count(o_orderkey) FILTER (o_orderdate >= TIMESTAMP '2001-01-30' AND o_orderdate <= TIMESTAMP '2001-08-01') AS n_recent, 100 * (c_nationkey % 3) + count(o_orderkey) FILTER (o_orderdate >= TIMESTAMP '2001-01-30' AND o_orderdate <= TIMESTAMP '2001-08-01') AS score
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey""")
def priority_recent_signals(spark, sf_dir):
    # the window's 183 days end with the reference day; the filter goes to the scan, the count is taken before the join
    recent = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp'2001-01-30' AND o_orderdate <= timestamp'2001-08-01'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").join(recent, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = F.coalesce("n", F.lit(0))
    return c.select("c_custkey", n.alias("n_recent"), (100 * (F.col("c_nationkey") % 3) + n).alias("score"))


@query("SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part WHERE p_partkey % 29 = 0) k WHERE starts_with(p_name, w))")
def prefix_scope_semi(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    words = p.filter("p_partkey % 29 = 0").select(F.substring_index("p_name", " ", 1).alias("w"))
    return J.in_scope(p, words, "p_name", "w")


@query("""WITH w AS (SELECT user_id, event_type, ts FROM events WHERE event_type IN ('view', 'signup'))
SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, user_id) - 1 AS pos FROM (SELECT DISTINCT user_id, event_type, ts FROM w)""")
def group_positions(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type IN ('view', 'signup')").select("user_id", "event_type", "ts").distinct()
    return J.numbered(e, "pos", "ts", by=["user_id", "event_type"]).select("user_id", "event_type", F.col("pos").cast("long").alias("pos"))


@query("SELECT o_orderkey % 6 AS shard, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def round_robin_shards(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.pmod("o_orderkey", F.lit(6)).alias("shard")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


# ---------------------------------------------------------------- coverage


CELLS = "SELECT event_type AS layer, CASE event_id % 3 WHEN 0 THEN 'done' WHEN 1 THEN 'candidate' ELSE 'absent' END AS status, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 't' || event_id % 5 END AS track FROM events"


def _cells(spark, sf_dir):
    i = F.col("event_id")
    track = F.when(i % 5 != 0, F.concat(F.lit("t"), i % 5))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("layer"), F.when(i % 3 == 0, "done").when(i % 3 == 1, "candidate").otherwise("absent").alias("status"), track.alias("track"), F.array_compact(F.array(track)).alias("tracks"))


@query(f"""WITH c AS ({CELLS}) SELECT layer, count(*) FILTER (status = 'done') AS n_done, count(*) FILTER (status = 'candidate') AS n_candidate, count(*) FILTER (status = 'absent') AS n_absent, {pct1_sql("count(*) FILTER (status = 'done')", "3000")} AS pct_done FROM c GROUP BY layer""")
def coverage_rollup(spark, sf_dir):
    return A.coverage_rollup(_cells(spark, sf_dir), 3000)


@query(f"""WITH c AS ({CELLS}) SELECT layer, coalesce(track, '(?)') AS track, count(*) AS n, 'done' AS kind FROM c WHERE status = 'done' GROUP BY ALL UNION ALL SELECT layer, coalesce(track, '(none)'), count(*), 'plan' FROM c WHERE status = 'candidate' GROUP BY ALL""")
def coverage_tracks(spark, sf_dir):
    return A.track_counts(_cells(spark, sf_dir))


@query(f"""WITH o AS (SELECT o_orderpriority, nullif(o_orderstatus, 'F') AS a, CASE WHEN o_totalprice > 150000 THEN o_totalprice END AS b, nullif(o_custkey % 4, 1) AS c FROM orders)
SELECT o_orderpriority, count(*) AS n_rows, sum((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT)::BIGINT AS n_published, {pct1_sql('sum((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT)', 'count(*) * 3')} AS published_pct FROM o GROUP BY 1""")
def published_field_pct(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.nullif("o_orderstatus", F.lit("F")).alias("a"), F.when(F.col("o_totalprice") > 150000, F.col("o_totalprice")).alias("b"), F.nullif(F.col("o_custkey") % 4, F.lit(1)).alias("c"))
    return A.published_pct(o, ["a", "b", "c"], "o_orderpriority")


@query(f"""WITH l AS (SELECT *, (l_quantity > 20)::INT + (l_discount > 0.04)::INT + (l_tax > 0.03)::INT AS n FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, {ORD}) AS rn FROM l)
SELECT l_suppkey AS best_key, l_orderkey, l_partkey, CASE WHEN l_quantity > 20 THEN l_quantity END AS a FROM r WHERE rn = 1""")
def merge_best_row(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(*ORDER, *[F.when(F.col(c) > m, F.col(c)).alias(n) for c, m, n in (("l_quantity", 20, "a"), ("l_discount", 0.04, "b"), ("l_tax", 0.03, "c"))])
    return A.best_row(l, F.col("l_suppkey"), ["a", "b", "c"], *ORDER).select("best_key", "l_orderkey", "l_partkey", "a")


@query(f"""WITH l AS (SELECT *, CASE WHEN l_quantity >= 10 THEN l_quantity END AS area FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY area IS NULL, {ORD}) AS rn FROM l) SELECT l_partkey, l_orderkey, area FROM r WHERE rn = 1""")
def role_first_with_area(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(*ORDER, F.when(F.col("l_quantity") >= 10, F.col("l_quantity")).alias("area"))
    return A.unit_row(l, "l_partkey", "area", *ORDER).select("l_partkey", "l_orderkey", "area")


@query("""WITH n AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT count(*) AS t FROM orders), d AS (SELECT o_orderstatus FROM n, t WHERE n >= 8 AND n >= 0.3 * t)
SELECT o_orderkey, o_orderstatus FROM orders WHERE (SELECT count(*) FROM d) = 0 OR o_orderstatus = (SELECT min(o_orderstatus) FROM d)""")
def dominant_shape(spark, sf_dir):
    return A.dominant(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 8, 0.3)


@query("""WITH l AS (SELECT c_custkey, unnest(['a', 'b', 'c']) AS attribute, unnest([c_mktsegment, n_name, c_name]) AS value FROM customer JOIN nation ON n_nationkey = c_nationkey), k AS (SELECT n_name FROM nation WHERE n_nationkey % 2 = 0)
SELECT attribute, count(DISTINCT value) AS n FROM l WHERE value IN (SELECT n_name FROM k) GROUP BY attribute HAVING count(DISTINCT value) >= 3 ORDER BY n DESC LIMIT 1""")
def pick_region_attribute(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_mktsegment").alias("a"), F.col("n_name").alias("b"), F.col("c_name").alias("c"))
    return GA.pick_attribute(c, ["a", "b", "c"], n.filter("n_nationkey % 2 = 0").select("n_name"), lambda x: x, 3)


@query("""WITH v AS (SELECT nullif(nullif(trim(CASE WHEN p_partkey % 6 = 0 THEN ' null ' ELSE p_brand END), ''), 'null') AS v FROM part) SELECT count(*) AS n, count(v) AS held, max(length(v))::INT AS longest, count(v) >= 0.5 * count(*) AND max(length(v)) BETWEEN 1 AND 24 AS fine FROM v""")
def zone_field_check(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 6 == 0, " null ").otherwise(F.col("p_brand")).alias("v"))
    return GA.field_is_code(p, "v")


DIS = """WITH c AS (SELECT c_mktsegment AS grp, 'n' || c_nationkey AS slug, c_acctbal FROM customer), r AS (SELECT 'n' || n_nationkey AS slug, n_regionkey FROM nation WHERE n_nationkey % 3 <> 0)
SELECT c.slug, grp, count(*) AS n_rows, count(r.slug) > 0 AS known, CASE WHEN count(r.slug) = 0 THEN 'unknown' WHEN count(*) < 10 THEN 'small' END AS reject FROM c LEFT JOIN r USING (slug) GROUP BY c.slug, grp"""


@query(DIS)
def disaggregate_groups(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.concat(F.lit("n"), "c_nationkey").alias("slug"), F.col("c_mktsegment").alias("grp")).agg(F.count("*").alias("n_rows"))
    r = table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 0").select(F.concat(F.lit("n"), "n_nationkey").alias("key"))
    both = J.left_lookup(c, r, F.col("slug"), "key", [])
    return both.select("slug", "grp", "n_rows", F.col("matched").alias("known"), F.when(~F.col("matched"), "unknown").when(F.col("n_rows") < 10, "small").alias("reject"))


# ---------------------------------------------------------------- gates and values


@query("""WITH b AS (SELECT o_orderkey, o_custkey % 9 AS az, o_custkey % 5 AS ap, o_orderkey % 9 AS bz, o_orderkey % 5 AS bp, o_orderkey % 4 = 0 AS fresh, o_orderkey % 7 AS oz, o_custkey % 4 AS op FROM orders),
w AS (SELECT *, CASE WHEN (az < 3) <> (bz < 3) THEN bz < 3 ELSE az > bz OR (az = bz AND ap > bp) END AS aw FROM b), x AS (SELECT *, CASE WHEN aw THEN az ELSE bz END AS z, CASE WHEN aw THEN ap ELSE bp END AS p FROM w)
SELECT o_orderkey, CASE WHEN aw THEN 'a' ELSE 'b' END AS winner, fresh OR (z >= oz AND p >= op AND (z > oz OR p > op)) AS replace FROM x""")
def keep_best_gate(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = lambda z, p: F.struct(z.alias("zones"), p.alias("published"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", pair(c % 9, c % 5).alias("a"), pair(k % 9, k % 5).alias("b"), F.when(k % 4 != 0, pair(k % 7, c % 4)).alias("old"))
    return GA.keep_best(o, "a", "b", "old").select("o_orderkey", "winner", "replace")


@query("SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_custkey % 110 > 2 AND o_custkey % 110 <= 100 AND (o_orderkey % 2 = 0 OR o_orderkey % 100 >= 75) AS committed FROM orders")
def clip_commit_gate(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", GA.clip_gate(k % 3 != 0, c % 110, k % 100, k % 2 != 0).alias("committed"))


@query("""WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'non-disponible' WHEN o_orderkey % 10 < 4 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT o_orderkey, d AS date FROM d WHERE d = 'non-disponible' OR CASE WHEN length(d) = 7 THEN d || '-31' >= '1998-02-10' AND d || '-01' <= '1998-08-12' ELSE d >= '1998-02-10' AND d <= '1998-08-12' END""")
def pv_window(spark, sf_dir):
    k = F.col("o_orderkey") % 10
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, Q.MISSING).when(k < 4, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))
    return o.filter(Q.in_window("date", "1998-02-10", "1998-08-12"))


STALE = "WITH c AS (SELECT event_id, ts, ['P1D', 'P1M', 'PT36H', 'P1Y2M3DT4H5M6S', 'P', 'weekly', 'P2W'][event_id % 7 + 1] AS cad, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS f FROM events)"


@query(STALE + """ SELECT event_id, CASE cad WHEN 'P1D' THEN 86400000 WHEN 'P1M' THEN 2592000000 WHEN 'PT36H' THEN 129600000 WHEN 'P1Y2M3DT4H5M6S' THEN 36993906000 END AS cadence_ms,
CASE WHEN f IS NULL OR cad IN ('P', 'weekly', 'P2W') THEN true ELSE epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(f) > CASE cad WHEN 'P1D' THEN 86400000 WHEN 'P1M' THEN 2592000000 WHEN 'PT36H' THEN 129600000 ELSE 36993906000 END END AS due FROM c""")
def staleness(spark, sf_dir):
    cad = F.element_at(F.array(*map(F.lit, ("P1D", "P1M", "PT36H", "P1Y2M3DT4H5M6S", "P", "weekly", "P2W"))), (F.col("event_id") % 7 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select("event_id", cad.alias("cad"), F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("f"))
    return e.select("event_id", Q.duration_ms("cad").alias("cadence_ms"), Q.is_stale("f", "cad", F.lit("2024-01-31 00:00:00")).alias("due"))


@query("""WITH p AS (SELECT p_partkey, ['12 m', '1 200 m²', '35%', '3 étages', 'Note 5', '—', '7,5 m', '-2', 'voir art. 73', ''][p_partkey % 10 + 1] AS raw FROM part)
SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 12.0 WHEN 1 THEN 1200.0 WHEN 2 THEN 35.0 WHEN 3 THEN 3.0 WHEN 6 THEN 7.5 WHEN 7 THEN -2.0 END::DOUBLE AS value,
CASE p_partkey % 10 WHEN 0 THEN 'm' WHEN 1 THEN 'm2' WHEN 2 THEN 'pct' WHEN 3 THEN 'etages' WHEN 4 THEN 'm' WHEN 6 THEN 'm' WHEN 7 THEN 'm' WHEN 8 THEN 'm' END AS unit, p_partkey % 10 IN (5, 9) AS absent FROM p""")
def unit_normalise(spark, sf_dir):
    raw = F.element_at(F.array(*map(F.lit, ("12 m", "1 200 m²", "35%", "3 étages", "Note 5", "—", "7,5 m", "-2", "voir art. 73", ""))), (F.col("p_partkey") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", Q.measure(raw, "m").alias("m")).select("p_partkey", "m.*")


@query("""SELECT p_partkey, ['marge_avant_min', 'marge_laterale_min', 'marge_arriere_min', 'hauteur_etages', 'hauteur_metres', 'frontage_min', 'superficie_min', 'densite', NULL][p_partkey % 9 + 1] AS field FROM part""")
def label_to_field(spark, sf_dir):
    labels = ("Marge avant (min.)", "Marge latérale", "Marge arrière minimale", "Hauteur maximale en étages", "Hauteur en mètres", "Largeur de façade min.", "Superficie min. du terrain", "Coefficient d'emprise au sol", "Marge avant max.")
    raw = F.element_at(F.array(*map(F.lit, labels)), (F.col("p_partkey") % 9 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", Q.field_of_label(raw).alias("field"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity END AS v, l_tax, l_linenumber % 2 = 0 AS fits FROM lineitem),
c AS (SELECT *, CASE WHEN v IS NULL THEN 0 ELSE least(0.97, 0.8 + l_tax * 3, CASE WHEN v BETWEEN 5 AND 45 THEN 1 ELSE 0.1 END, CASE WHEN fits THEN 1 ELSE 0 END) END AS conf FROM l)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN conf >= 0.85 THEN v END AS value, conf::DOUBLE AS confidence, CASE WHEN conf < 0.85 THEN CASE WHEN v IS NULL THEN 'absent' ELSE 'a-verifier' END END AS flag FROM c""")
def confidence_gate(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("v", F.when(F.col("l_linenumber") != 4, F.col("l_quantity")))
    got = Q.gated("v", F.lit(0.8) + F.col("l_tax") * 3, F.lit(5), F.lit(45), F.col("l_linenumber") % 2 == 0)
    return l.select(*ORDER, got.alias("g")).select(*ORDER, "g.*")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORD}) AS rn FROM lineitem), p AS (SELECT a.l_orderkey, a.l_quantity AS x, b.l_quantity AS y FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.rn = 1 AND b.rn = 2)
SELECT l_orderkey, CASE WHEN floor(x / 10) = floor(y / 10) AND floor(x / 10) * 10 BETWEEN 10 AND 40 THEN floor(x / 10) * 10 END AS value, CASE WHEN floor(x / 10) = floor(y / 10) AND floor(x / 10) * 10 BETWEEN 10 AND 40 THEN 0.92 ELSE 0.0 END::DOUBLE AS confidence, CASE WHEN floor(x / 10) <> floor(y / 10) THEN 'divergence-2-passes' WHEN NOT floor(x / 10) * 10 BETWEEN 10 AND 40 THEN 'hors-plage' END AS flag FROM p""")
def two_pass_concordance(spark, sf_dir):
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER))
    l = table(spark, sf_dir, "lineitem").select(*ORDER, "l_quantity").withColumn("rn", rn).filter("rn <= 2")
    # both readings of an order come from one pass, without joining the table to itself
    two = l.groupBy("l_orderkey").agg(F.max(F.when(F.col("rn") == 1, F.col("l_quantity"))).alias("x"), F.max(F.when(F.col("rn") == 2, F.col("l_quantity"))).alias("y")).filter("y IS NOT NULL")
    cell = lambda c: F.concat((F.floor(F.col(c) / 10) * 10).cast("string"), F.lit(" m"))
    return two.select("l_orderkey", Q.two_readings(cell("x"), cell("y"), F.lit("length"), F.lit(10), F.lit(40)).alias("t")).select("l_orderkey", "t.*")


@query("""SELECT source, CASE source WHEN 'src0' THEN 'cc-by-4.0' WHEN 'src1' THEN 'odbl-1.0' WHEN 'src2' THEN 'proprietary' WHEN 'src3' THEN 'cc0-1.0' ELSE 'unknown' END AS licence, source IN ('src0', 'src1', 'src3') AS redistributable, CASE WHEN source IN ('src0', 'src1', 'src3') THEN 'open' ELSE 'blocked' END AS rights FROM documents GROUP BY source""")
def licence_resolve(spark, sf_dir):
    names = {"src0": " CC-BY ", "src1": "ODbL", "src2": "Proprietary", "src3": "cc0"}
    said = F.col("source")
    for k, v in names.items():
        said = F.when(F.col("source") == k, v).otherwise(said)
    d = table(spark, sf_dir, "documents").select("source").distinct().withColumn("licence", GA.licence_id(said))
    both = d.join(GA.licences(spark), "licence")
    return both.select("source", "licence", "redistributable", GA.rights_profile(F.lit(None).cast("string"), "redistributable").alias("rights"))


@query("""SELECT n_nationkey, n_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE upper(r_name) = 'EUROPE' AND n_nationkey % 2 = 0""")
def inventory_filter(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).filter((F.upper("r_name") == F.upper(F.lit("Europe"))) & (F.col("n_nationkey") % 2 == 0)).select("n_nationkey", "n_name")


@query("""WITH e AS (SELECT event_id, (props::JSON->>'k')::BIGINT AS k, event_type AS name FROM events) SELECT event_id, k, CASE WHEN k % 3 = 0 THEN NULL ELSE name END AS name FROM e WHERE k IS NOT NULL""")
def json_features(spark, sf_dir):
    doc = F.try_parse_json("props")
    e = table(spark, sf_dir, "events").select("event_id", F.try_variant_get(doc, "$.k", "bigint").alias("k"), "event_type")
    return e.filter("k IS NOT NULL").select("event_id", "k", F.when(F.col("k") % 3 != 0, F.col("event_type")).alias("name"))


@query("""SELECT 'k' AS key, CASE WHEN count(*) FILTER (event_id % 50 <> 0) < count(*) THEN 'DOUBLE' ELSE 'BIGINT' END AS type FROM events UNION ALL SELECT 't', 'STRING' UNION ALL SELECT 'b', 'BOOLEAN' UNION ALL SELECT 'n', 'BIGINT'""")
def schema_inference(spark, sf_dir):
    i = F.col("event_id")
    entries = F.create_map(F.lit("k"), F.when(i % 50 != 0, F.get_json_object("props", "$.k")), F.lit("t"), F.col("event_type"), F.lit("b"), (i % 2 == 0).cast("string"), F.lit("n"), i.cast("string"))
    return S.inferred_types(table(spark, sf_dir, "events").select(entries.alias("e")), "e")


@query("""WITH l AS (SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT l_partkey, l_orderkey || '-1-' || l_suppkey AS matricule, (l_quantity * 1000)::BIGINT AS total_cad, CASE WHEN l_quantity < 25 THEN NULL ELSE l_linenumber END::BIGINT AS floors, 1::BIGINT AS n_lots FROM l WHERE rn = 1""")
def xml_units(spark, sf_dir):
    l = J.first_wins(table(spark, sf_dir, "lineitem").select(*ORDER, "l_quantity"), "l_partkey", *ORDER)
    tag = lambda t, c: F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>"))
    lot = tag("RL0103", F.concat(*[tag("RL0103x", tag("RL0103Ax", F.col("l_partkey").cast("string")))] * 2))
    xml = tag("RLUEx", F.concat(lot, tag("RL0104A", F.col("l_orderkey").cast("string")), F.lit("<RL0104B>1</RL0104B>"), tag("RL0104C", F.col("l_suppkey").cast("string")), F.when(F.col("l_quantity") >= 25, tag("RL0306A", F.col("l_linenumber").cast("string"))).otherwise(""), tag("RL0404A", F.concat(F.col("l_quantity").cast("int"), F.lit(" 000")))))
    u = S.units_of_text(l.select("l_partkey", xml.alias("xml")), "xml")
    return u.select("l_partkey", "matricule", "total_cad", "floors", F.size("lots").cast("long").alias("n_lots"))


@query("""SELECT l_partkey, 'z' || z AS zone, v AS value FROM (SELECT l_partkey, unnest([1, 2, 3]) AS z, unnest([sum(CASE WHEN l_linenumber = 1 THEN l_quantity END), sum(CASE WHEN l_linenumber = 2 THEN l_quantity END), sum(CASE WHEN l_linenumber = 3 THEN l_quantity END)]) AS v FROM lineitem GROUP BY l_partkey) WHERE v IS NOT NULL""")
def zone_columns_unpivot(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 3").groupBy("l_partkey").pivot("l_linenumber", [1, 2, 3]).agg(F.sum("l_quantity"))
    long = l.unpivot(["l_partkey"], ["1", "2", "3"], "zone", "value").filter("value IS NOT NULL")
    return long.select("l_partkey", F.concat(F.lit("z"), "zone").alias("zone"), "value")


@query(f"SELECT doc_id, 'raw:docs:' || sha256(text) AS doc_key, 'raw/docs/cas/' || sha256(text) || '.txt' AS storage_key, strlen(text) AS n_bytes FROM documents")
def content_address(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return S.raw_documents(d, "docs", "text", F.lit("Text/Plain; charset=utf-8")).select("doc_id", "doc_key", "storage_key", "n_bytes")


@query("""SELECT event_id, '{"a":[1,{"x":' || (event_id % 5) || ',"y":"é"}],"id":' || event_id || ',"p":' || props || '}' AS canonical FROM events""".replace("|| props ||", "|| replace(props, ' ', '') ||"))
def canonical_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.concat(F.lit('{"p": '), "props", F.lit(', "id": '), F.col("event_id").cast("string"), F.lit('.0, "a": [1, {"y": "é", "x": '), (F.col("event_id") % 5).cast("string"), F.lit("}]}"))
    return e.select("event_id", S.canonical_json(raw).alias("canonical"))


@query(f"SELECT p_partkey, {FOLD.format('p_name')} AS folded, regexp_replace(regexp_replace({FOLD.format('p_name')}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, regexp_replace(replace(upper(p_brand), ' ', ''), '^([A-Z]+)-?0*([0-9])', '\\1-\\2') AS zone FROM part")
def slug_fold(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", TX.fold("p_name").alias("folded"), TX.slug_segment("p_name").alias("slug"), TX.canon_zone("p_brand").alias("zone"))


@query("SELECT s_suppkey, 'ca/' || regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g') || '/locality/' || s_nationkey AS geo_id, CASE WHEN s_suppkey % 4 = 0 THEN 'EPSG:4326' WHEN s_suppkey % 4 = 1 THEN 'EPSG:32188' WHEN s_suppkey % 4 = 2 THEN 'EPSG:2950' END AS crs FROM supplier")
def geo_id_crs(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    said = F.when(k == 0, "OGC:CRS84").when(k == 1, "urn:ogc:def:crs:EPSG::32188").when(k == 2, "http://www.opengis.net/def/crs/EPSG/0/02950").otherwise("local")
    return table(spark, sf_dir, "supplier").select("s_suppkey", TX.geo_id(F.lit("CA"), "s_name", F.lit(""), F.lit("Locality"), F.col("s_nationkey").cast("string")).alias("geo_id"), TX.crs_code(said).alias("crs"))
