"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import history, places, series as S, snapshots, vintage
from tidemark.operators.leadlag import aligned, lag_table, with_split
from tidemark.operators.neighbours import nearest
from tidemark.plans import model as M
from tidemark.plans.catalog.base import BRIDGE, MARKED, MUN, PLAIN, R, REV, obs_sql, query, r, values_sql
from tidemark.session import cut_lineage, literal_table, scratch_path


@query(
    "j1_registry_join",
    obs_sql("revenue", "orders_quarter", "discount_rate")
    + f""", {values_sql('reg', 'metric_id, label, unit', [(m[0], m[1], m[2]) for m in M.METRICS if m[0] != 'discount_rate'])}
    SELECT o.metric_id, o.geo_id, o.pidx, o.value, reg.label, reg.unit FROM obs o LEFT JOIN reg USING (metric_id)""",
)
def registry_join(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue", "orders_quarter", "discount_rate"])
    reg = M.registry(spark).where(F.col("metric_id") != "discount_rate").select("metric_id", "label", "unit")
    return obs.join(reg, "metric_id", "left").select("metric_id", "geo_id", "pidx", "value", "label", "unit")


@query(
    "j2_place_resolution",
    obs_sql("orders_count", "qty_shipped", "discount_rate", "world_revenue", "segment_orders")
    + f""", {BRIDGE} SELECT b.place, o.metric_id, o.geo_id, o.geo_level, o.pidx, o.value FROM obs o JOIN bridge b ON o.geo_level = b.geo_level AND o.geo_id = b.geo_id""",
)
def place_resolution(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "qty_shipped", "discount_rate", "world_revenue", "segment_orders"])
    out = places.resolve(obs, places.bridge(M.places(spark, sf_dir)))
    return out.select("place", "metric_id", "geo_id", "geo_level", "pidx", "value")


@query(
    "j3_parts_of_place",
    obs_sql("segment_orders")
    + """ SELECT lower(n_name) AS place, geo_id, count(*) AS periods, sum(value)::DOUBLE AS orders FROM obs
    JOIN nation ON split_part(geo_id, '-', 2) = printf('%05d', n_nationkey + 1) GROUP BY ALL""",
)
def parts_of_place(spark, sf_dir):
    out = places.parts_of(M.series(spark, sf_dir, ["segment_orders"]), M.districts(spark, sf_dir))
    return out.groupBy("place", "geo_id").agg(F.count(F.lit(1)).alias("periods"), F.sum("value").alias("orders"))


@query(
    "j4_ratio_of_series",
    obs_sql("revenue", "orders_count", "qty_shipped")
    + f""", a AS (SELECT * FROM obs WHERE metric_id = 'revenue'), b AS (SELECT * FROM obs WHERE metric_id = 'orders_count'),
    q AS (SELECT pidx, sum(value) AS value FROM obs WHERE metric_id = 'qty_shipped' GROUP BY pidx), w AS (SELECT pidx, sum(value) AS value FROM b GROUP BY pidx)
    SELECT a.geo_id, a.pidx, {R('1000.0::DOUBLE * a.value / b.value', 3)} AS value FROM a JOIN b ON a.geo_id = b.geo_id AND a.pidx = b.pidx WHERE b.value <> 0
    UNION ALL SELECT 'all', q.pidx, {R('q.value / w.value', 3)} FROM q JOIN w ON q.pidx = w.pidx WHERE w.value <> 0""",
)
def ratio_of_series(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["revenue", "orders_count", "qty_shipped"])
    same = S.ratio_of_metrics(obs, "revenue", "orders_count", scale=1000.0)

    def total(metric):
        return obs.where(F.col("metric_id") == metric).groupBy("pidx").agg(F.sum("value").alias("value"))

    whole = S.ratio(total("qty_shipped"), total("orders_count"), on=("pidx",)).withColumn("geo_id", F.lit("all"))
    return same.unionByName(whole).select("geo_id", "pidx", r("value", 3))


@query(
    "j5_l5_asof_denominator",
    obs_sql("orders_count", "buyers_annual")
    + f""", n AS (SELECT * FROM obs WHERE metric_id = 'orders_count'),
    d AS (SELECT geo_id, unnest(range(pidx * 12, pidx * 12 + 12)) AS month, value FROM obs WHERE metric_id = 'buyers_annual'),
    m AS (SELECT n.geo_id, n.pidx, n.value, arg_max(d.value, d.month) AS base FROM n JOIN d ON n.geo_id = d.geo_id AND d.month BETWEEN n.pidx - 12 AND n.pidx GROUP BY ALL)
    SELECT geo_id, pidx, {R('1000.0::DOUBLE * value / base')} AS per_1000 FROM m WHERE base <> 0""",
)
def asof_denominator(spark, sf_dir):
    obs = M.series(spark, sf_dir, ["orders_count", "buyers_annual"])
    stock = obs.where(F.col("metric_id") == "buyers_annual")
    monthly = S.to_months(stock).select("geo_id", F.col("month").alias("pidx"), "value")
    num = obs.where(F.col("metric_id") == "orders_count").select("geo_id", "pidx", "value")
    out = S.carry_denominator(num, monthly, 12, scale=1000.0)
    return out.select("geo_id", "pidx", r("value").alias("per_1000"))


def _batch(spark, sf_dir):
    """History of all but the last year, and a batch restating it with duplicates."""
    log = cut_lineage(M.revision_log(spark, sf_dir))
    stored = log.where((F.col("revision") == 0) & (F.col("pidx") < 24000))
    last = log.where(F.col("revision") == 2)
    again = last.withColumns({"seq": F.lit(5).cast("bigint"), "value": F.col("value") + 1})
    return stored, last.withColumn("revision", F.lit(0)).unionByName(again)


_MERGE = f"""WITH {REV}, o AS (SELECT * FROM rlog WHERE revision = 0 AND pidx < 24000), n AS (SELECT * FROM rlog WHERE revision = 2),
  j AS (SELECT n.geo_id, n.pidx, n.value, o.value AS prior_value, CASE WHEN o.geo_id IS NULL THEN 'added' WHEN round(o.value, 6) = round(n.value, 6) THEN 'unchanged' ELSE '@other' END AS action
    FROM n LEFT JOIN o ON n.geo_id = o.geo_id AND n.pidx = o.pidx)"""


@query(
    "j6_merge_with_revisions",
    _MERGE.replace("@other", "revised") + " SELECT geo_id, pidx, value, prior_value, action, (action = 'revised')::INTEGER AS revision FROM j",
)
def merge_with_revisions(spark, sf_dir):
    log, batch = _batch(spark, sf_dir)
    path = scratch_path(spark, "log")
    history.write_log(log, path)
    out = history.merge_stored(path, batch, True)
    return out.select("geo_id", "pidx", "value", "prior_value", "action", "revision")


@query(
    "j6_a19_merge_refusing_revisions",
    _MERGE.replace("@other", "quarantined")
    + """ SELECT geo_id, count(*) FILTER (WHERE action = 'added') AS added, count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'revised') AS revised,
      count(*) FILTER (WHERE action = 'quarantined') AS quarantined FROM j GROUP BY geo_id""",
)
def merge_refusing_revisions(spark, sf_dir):
    return history.merge_counts(history.merge(*_batch(spark, sf_dir), False), ["geo_id"])


_PAIR = [("orders_count", "revenue"), ("avg_ticket", "return_rate")]


def _placed(spark, sf_dir, metrics):
    obs = M.series(spark, sf_dir, metrics)
    return places.resolve(obs, places.bridge(M.places(spark, sf_dir)))


@query(
    "j7_shifted_pairs",
    obs_sql("orders_count", "revenue", "avg_ticket", "return_rate")
    + f""", {BRIDGE}, pl AS (SELECT b.place, o.metric_id, o.pidx, o.value FROM obs o JOIN bridge b USING (geo_level, geo_id)),
    y AS (SELECT o.place, o.metric_id, o.pidx, 100.0::DOUBLE * (o.value - p.value) / abs(p.value) AS yoy FROM pl o JOIN pl p ON o.place = p.place AND o.metric_id = p.metric_id AND p.pidx = o.pidx - 12 WHERE p.value <> 0),
    {values_sql('pairs', 'signal, outcome', _PAIR)}
    SELECT s.place, pairs.signal, pairs.outcome, (o.pidx - s.pidx)::INTEGER AS lag, count(*) AS pairs, {R('CASE WHEN count(*) >= 3 THEN corr(s.yoy, o.yoy) END')} AS r
    FROM pairs JOIN y s ON s.metric_id = pairs.signal JOIN y o ON o.metric_id = pairs.outcome AND o.place = s.place AND o.pidx - s.pidx BETWEEN 0 AND 12 GROUP BY ALL""",
)
def shifted_pairs(spark, sf_dir):
    placed = _placed(spark, sf_dir, ["orders_count", "revenue", "avg_ticket", "return_rate"])
    pairs = literal_table(spark, "signal string, outcome string", _PAIR)
    rows = aligned(placed, pairs)
    # No hold-out here: every pair of every lag counts.
    flat = lag_table(with_split(rows, holdout=None)).where(F.col("n_test") > 0)
    return flat.select("place", "signal", "outcome", "lag", F.col("n_test").alias("pairs"), r("test_r").alias("r"))


_KNOWN = f"""WITH {REV}, k AS (SELECT *, coalesce(published_at, observation_end + 60) AS known_from FROM rlog)"""


@query(
    "j8_as_of_view",
    _KNOWN + " SELECT geo_id, pidx, arg_max(value, revision) AS value, max(revision) AS revision FROM k WHERE known_from <= DATE '1998-09-30' GROUP BY ALL",
)
def as_of_view(spark, sf_dir):
    dated = vintage.with_known_from(M.revision_log(spark, sf_dir), literal_table(spark, "source_id string, days int", M.LAGS))
    return vintage.as_of(dated, "1998-09-30").select("geo_id", "pidx", "value", "revision")


_DATES = ["1996-06-30", "1998-09-30", "2000-01-31", "2001-12-31"]


@query(
    "j8_as_of_many_dates",
    _KNOWN
    + f""" SELECT d::VARCHAR AS as_of, geo_id, pidx, arg_max(value, revision) AS value, max(revision) AS revision FROM k, (SELECT unnest([{', '.join(f"DATE '{d}'" for d in _DATES)}]) AS d)
    WHERE known_from <= d GROUP BY ALL""",
)
def as_of_many_dates(spark, sf_dir):
    dated = vintage.with_known_from(M.revision_log(spark, sf_dir), literal_table(spark, "source_id string, days int", M.LAGS))
    keys = ("geo_id", "pidx")
    return vintage.as_of_many(dated, _DATES, keys).withColumn("as_of", F.col("as_of").cast("string"))


def customer_snapshots(spark, sf_dir, dates: list[str]):
    """For each date every customer's latest order status and priority before it, from one pass over the orders."""
    newest = F.struct("o_orderdate", "o_orderkey")
    state = F.struct(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("state"))
    o = M.table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(max(dates)).cast("timestamp_ntz"))
    last = o.groupBy("o_custkey").agg(
        *[F.max_by(state, F.when(F.col("o_orderdate") < F.lit(d).cast("timestamp_ntz"), newest)).alias(f"s{i}") for i, d in enumerate(dates)]
    )
    c = M.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), M.mun("c_nationkey").alias("district"))
    every = cut_lineage(last.join(c, "o_custkey"))
    return [every.where(F.col(f"s{i}").isNotNull()).select(F.col("o_custkey").alias("id"), f"s{i}.kind", "district", f"s{i}.state") for i in range(len(dates))]


def snapshot_sql(name: str, until: str) -> str:
    return (
        f"{name} AS (SELECT o_custkey AS id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS kind, "
        f"any_value({MUN.replace('nk', 'c_nationkey')}) AS district, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS state "
        f"FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '{until}' GROUP BY o_custkey)"
    )


COLUMNS = ["kind", "district", "state"]
DIFF = """d AS (SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' WHEN a.state IS DISTINCT FROM b.state THEN 'state_changed' ELSE 'attributes_changed' END AS change,
  a.id IS NOT NULL AS has_old, b.id IS NOT NULL AS has_new, a.state AS old_state, b.state AS new_state, a.kind AS old_kind, b.kind AS new_kind, a.district AS old_district, b.district AS new_district
  FROM a FULL OUTER JOIN b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL OR (a.kind, a.district, a.state) IS DISTINCT FROM (b.kind, b.district, b.state))"""


@query(
    "j9_snapshot_diff",
    f"WITH {snapshot_sql('a', '1995-06-01')}, {snapshot_sql('b', '1996-06-01')}, {DIFF} SELECT id, change, old_state, new_state FROM d",
)
def snapshot_diff(spark, sf_dir):
    d = snapshots.diff(*customer_snapshots(spark, sf_dir, ["1995-06-01", "1996-06-01"]), "id", COLUMNS, "state")
    return d.select("id", "change", F.col("old.state").alias("old_state"), F.col("new.state").alias("new_state"))


@query(
    "j10_replay_changes",
    f"WITH {snapshot_sql('b', '1998-01-01')} SELECT id, kind, district, state FROM b WHERE id % 10 <> 3",
)
def replay_changes(spark, sf_dir):
    # Base plus two yearly differences, then a removal, gives the later state.
    dates = ["1996-01-01", "1997-01-01", "1998-01-01"]
    snaps = customer_snapshots(spark, sf_dir, dates)
    log = None
    for i in (1, 2):
        step = snapshots.diff(snaps[i - 1], snaps[i], "id", COLUMNS, "state").withColumn("pidx", F.lit(i))
        log = step if log is None else log.unionByName(step)
    gone = snaps[2].where(F.col("id") % 10 == 3).select(
        "id", F.lit("removed").alias("change"), F.lit(None).cast(log.schema["old"].dataType).alias("old"),
        F.lit(None).cast(log.schema["new"].dataType).alias("new"), F.lit(3).alias("pidx"),
    )
    return snapshots.replay(snaps[0], log.unionByName(gone), 3, "id", COLUMNS)


@query(
    "j12_pooled_neighbours",
    f"""WITH t AS (SELECT label AS target, arg_min(embedding, vec_id) AS v, min(vec_id) AS tid FROM embeddings GROUP BY label),
    d AS (SELECT t.target, e.vec_id, e.label, sqrt(list_sum(list_transform(list_zip(t.v, e.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))) AS distance
      FROM t, embeddings e WHERE e.vec_id NOT IN (SELECT tid FROM t))
    SELECT target, vec_id, label, {R('distance', 6)} AS distance, position FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY distance, vec_id) AS position FROM d) WHERE position <= 12""",
)
def pooled_neighbours(spark, sf_dir):
    e = M.table(spark, sf_dir, "embeddings").withColumn("vector", F.col("embedding").cast("array<double>"))
    firsts = e.groupBy(F.col("label").alias("target")).agg(F.min_by("vector", "vec_id").alias("vector"), F.min("vec_id").alias("tid"))
    pool = e.join(firsts.select(F.col("tid").alias("vec_id")), "vec_id", "left_anti").select("vec_id", "label", "vector")
    near = nearest(pool, firsts.select("target", "vector"), 12, ("vec_id",), ("label",), slices=2)
    return near.select("target", "vec_id", "label", r("distance", 6), F.col("position").cast("bigint").alias("position"))


_WORDS = [("ACCOUNT", "acc"), ("THE ", "the"), ("LE ", "le"), ("UND", "und")]


@query(
    "j13_text_to_code",
    f"""WITH k AS (SELECT lang, upper(translate(text, '{MARKED}', '{PLAIN}')) AS key FROM documents),
    c AS (SELECT lang, CASE {' '.join(f"WHEN contains(key, '{w.rstrip()}') THEN '{c}'" if not w.endswith(' ') else f"WHEN contains(regexp_replace(key, '[ \t\n]+', ' ', 'g'), '{w}') THEN '{c}'" for w, c in _WORDS)} END AS code FROM k)
    SELECT lang, code, count(*) AS documents FROM c WHERE code IS NOT NULL GROUP BY ALL""",
)
def text_to_code(spark, sf_dir):
    d = M.table(spark, sf_dir, "documents").select("lang", X.first_code_by_keyword("text", _WORDS).alias("code"))
    return d.where(F.col("code").isNotNull()).groupBy("lang", "code").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "j13_normalised_name_join",
    "SELECT n_nationkey, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL",
)
def normalised_name_join(spark, sf_dir):
    # Names arrive with accents, stray blanks and another case.
    names = M.table(spark, sf_dir, "nation").select("n_nationkey", X.normalise_name("n_name").alias("key"))
    spelled = F.concat(F.lit("  distrito Nàtión_"), F.col("c_nationkey").cast("string"), F.lit(" "))
    c = M.table(spark, sf_dir, "customer").select(X.normalise_name(spelled, "distrito").alias("key"))
    return c.join(names, "key").groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "j13_alias_lists",
    """WITH a AS (SELECT n_nationkey, n_name AS k FROM nation UNION ALL SELECT n_nationkey, 'REPUBLIC OF ' || n_name FROM nation
      UNION ALL SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
    f AS (SELECT upper(k) AS k, min(n_nationkey) AS code FROM a GROUP BY ALL),
    s AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'REPUBLIC OF ' || n_name ELSE r_name END AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT code AS n_nationkey, count(*) AS suppliers FROM s JOIN f ON upper(s.k) = f.k GROUP BY ALL""",
)
def alias_lists(spark, sf_dir):
    """Places with several names; a name that several claim (the region's) goes to the first of them."""
    n = M.table(spark, sf_dir, "nation").join(M.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = n.select("n_nationkey", "n_name", "r_name", F.array("n_name", F.concat(F.lit("Republic  of "), "n_name"), F.lower("r_name")).alias("aliases"))
    table = X.alias_table(dim, "n_nationkey", "aliases", "n_nationkey")
    s = M.table(spark, sf_dir, "supplier").join(dim.withColumnRenamed("n_nationkey", "nk"), F.col("s_nationkey") == F.col("nk"))
    kind = F.col("s_suppkey") % 3
    name = F.when(kind == 0, F.initcap("n_name")).when(kind == 1, F.concat(F.lit(" république of "), F.lower("n_name"))).otherwise(F.col("r_name"))
    named = s.select(F.replace(name, F.lit("république"), F.lit("républic")).alias("name"))
    return X.by_alias(named, "name", table, "inner").groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))


@query(
    "j14_code_remap",
    "SELECT CASE c_mktsegment[1:2] WHEN 'AU' THEN '01' WHEN 'BU' THEN '02' WHEN 'FU' THEN '03' WHEN 'HO' THEN '04' END AS code, count(*) AS n FROM customer WHERE c_mktsegment[1:2] <> 'MA' GROUP BY ALL",
)
def code_remap(spark, sf_dir):
    plates = literal_table(spark, "letters string, code string", [("AU", "01"), ("BU", "02"), ("FU", "03"), ("HO", "04")])
    c = M.table(spark, sf_dir, "customer").select(F.substring("c_mktsegment", 1, 2).alias("letters"))
    return c.join(plates, "letters").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j17_wide_district_table",
    obs_sql("segment_orders", "segment_ticket")
    + f""", l AS (SELECT geo_id, metric_id, arg_max(value, pidx) AS value FROM obs GROUP BY ALL)
    SELECT geo_id, {R("max(value) FILTER (WHERE metric_id = 'segment_ticket')")} AS ticket, {R("max(value) FILTER (WHERE metric_id = 'segment_orders')")} AS orders FROM l GROUP BY geo_id
    HAVING max(value) FILTER (WHERE metric_id = 'segment_ticket') IS NOT NULL""",
)
def wide_district_table(spark, sf_dir):
    from tidemark.plans.dashboards import wide_latest

    obs = M.series(spark, sf_dir, ["segment_orders", "segment_ticket"])
    out = wide_latest(obs, {"segment_ticket": "ticket", "segment_orders": "orders"}, required="ticket")
    return out.select("geo_id", r("ticket"), r("orders"))


@query(
    "j18_state_vectors",
    obs_sql("orders_count", "avg_ticket", "open_share")
    + """, p AS (SELECT geo_id, pidx, max(value) FILTER (WHERE metric_id = 'orders_count') AS a, max(value) FILTER (WHERE metric_id = 'avg_ticket') AS b, max(value) FILTER (WHERE metric_id = 'open_share') AS c FROM obs GROUP BY ALL)
    SELECT geo_id, pidx, a, b, c FROM p WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL""",
)
def state_vectors(spark, sf_dir):
    from tidemark.operators.regimes import wide_indices
    from tidemark.operators.transition import state_vectors as vectors

    ids = ["avg_ticket", "open_share", "orders_count"]
    obs = M.series(spark, sf_dir, ids)
    long = obs.select(F.col("geo_id").alias("place"), F.col("metric_id").alias("index_id"), F.col("pidx").alias("month"), "value")
    v = vectors(wide_indices(long, ids), ids)
    return v.select(
        F.col("place").alias("geo_id"), F.col("month").alias("pidx"), *[F.col("vector")[i].alias(n) for i, n in enumerate(("b", "c", "a"))]
    )


@query(
    "j19_semi_and_anti",
    """SELECT 'tracked' AS side, count(*) AS orders FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT 'no lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def semi_and_anti(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    tracked = M.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    lines = M.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    a = o.join(tracked, "o_custkey", "left_semi").agg(F.count(F.lit(1)).alias("orders")).select(F.lit("tracked").alias("side"), "orders")
    b = o.join(lines, "o_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("orders")).select(F.lit("no lines").alias("side"), "orders")
    return a.unionByName(b)
