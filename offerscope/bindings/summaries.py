"""Group summaries on the order, customer, part and event tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from offerscope.bindings.registry import MIDDLE, half_up, nearest, pct, query, ranked, table
from offerscope.functions.labels import flag
from offerscope.functions.text import percent, round_half_up
from offerscope.operators import checks
from offerscope.operators.groups import (crosstab, fixed_bins, rank_by, rank_within, seeded_sample, share_of_total,
                                         share_within, top_n, top_n_per_group, value_counts, weighted_mean,
                                         with_grand_total)
from offerscope.operators.pairs import pair_lift
from offerscope.operators.premium import premium
from offerscope.operators.quantiles import BOX, QUARTILES_NEAREST, Quantile, quantiles
from offerscope.plans.profile import median_matrix, rates

# Closed domains of the order tables: priorities, states, market segments, nations.


def _cents(value: str):
    return F.col(value).cast("decimal(18,2)")


def _mean(value: str, digits: int = 2):
    return round_half_up(F.sum(_cents(value)).cast("double") / F.count(value), digits)


def _sql_mean(value: str, digits: int = 2) -> str:
    return half_up(f"CAST(SUM(CAST({value} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({value})", digits)


@query("kpi_global", f"""
SELECT COUNT(*) AS nb_orders, COUNT(DISTINCT o_custkey) AS nb_customers,
       COUNT(DISTINCT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END) AS nb_priorities,
       {_sql_mean('o_totalprice')} AS mean_price,
       (SELECT {half_up('AVG(v)', 2)} FROM {ranked('orders', '', 'o_totalprice')} WHERE {MIDDLE}) AS median_price,
       {pct("COUNT(*) FILTER (WHERE o_orderstatus = 'F')", "COUNT(*)")} AS pct_done,
       {pct("COUNT(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))", "COUNT(*)")} AS pct_pressing,
       CAST(MIN(o_orderdate) AS DATE) AS date_min, CAST(MAX(o_orderdate) AS DATE) AS date_max
FROM orders""")
def kpi_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    middle = quantiles(orders, [], "o_totalprice", [Quantile("m")]).select("m").scalar()
    known = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority"))
    done = flag(F.col("o_orderstatus") == "F")
    pressing = flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    out = orders.agg(
        F.count(F.lit(1)).alias("nb_orders"), F.count_distinct("o_custkey").alias("nb_customers"),
        F.count_distinct(known).alias("nb_priorities"), _mean("o_totalprice").alias("mean_price"),
        percent(F.sum(done), F.count(done)).alias("pct_done"),
        percent(F.sum(pressing), F.count(pressing)).alias("pct_pressing"),
        F.min("o_orderdate").cast("date").alias("date_min"), F.max("o_orderdate").cast("date").alias("date_max"))
    return out.withColumn("median_price", round_half_up(middle, 2))


@query("salary_by_role_seniority", f"""
SELECT o_orderpriority, o_orderstatus, MAX(cnt) AS n, {half_up('AVG(CASE WHEN ' + MIDDLE + ' THEN v END)', 2)} AS median,
       {nearest(0.25)} AS q1, {nearest(0.75)} AS q3, MIN(v) AS low, MAX(v) AS high, {_sql_mean('v')} AS mean,
       CASE WHEN MAX(cnt) >= 1000 THEN 'Bonne' WHEN MAX(cnt) >= 10 THEN 'Moyenne' ELSE 'Faible' END AS band
FROM {ranked('orders', 'o_orderpriority, o_orderstatus', 'o_totalprice')}
GROUP BY o_orderpriority, o_orderstatus""")
def salary_by_role_seniority(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, keys = table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]
    ranks = quantiles(orders, keys, "o_totalprice", QUARTILES_NEAREST)
    moments = orders.groupBy(*keys).agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
                                        _mean("o_totalprice").alias("mean"))
    n = F.col("n")
    band = F.when(n >= 1000, F.lit("Bonne")).when(n >= 10, F.lit("Moyenne")).otherwise(F.lit("Faible"))
    return ranks.join(moments, keys).withColumn("median", round_half_up(F.col("median"), 2)).withColumn("band", band)


@query("median_open_groups", f"""
SELECT o_custkey, MAX(cnt) AS n, AVG(v) FILTER (WHERE {MIDDLE}) AS median, {nearest(0.25)} AS q1, {nearest(0.75)} AS q3
FROM {ranked('orders', 'o_custkey', 'o_totalprice')} GROUP BY o_custkey""")
def median_open_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians over an open-ended grouping."""
    return quantiles(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", QUARTILES_NEAREST)


@query("city_summary", f"""
WITH place AS (SELECT n_name AS city, r_name AS region, c_acctbal AS bal, c_mktsegment AS seg
               FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
med AS (SELECT city, AVG(v) AS m, MAX(cnt) AS n FROM {ranked('(SELECT * FROM place WHERE bal >= 0)', 'city', 'bal')}
        WHERE {MIDDLE} GROUP BY city)
SELECT p.city, p.region, COUNT(*) AS n, {pct('COUNT(*)', '(SELECT COUNT(*) FROM customer)', 2)} AS share_pct,
       {half_up('MAX(med.m)', 2)} AS median_balance, COALESCE(MAX(med.n), 0) AS n_balance,
       {pct("COUNT(*) FILTER (WHERE p.seg IN ('BUILDING', 'MACHINERY'))", "COUNT(*)")} AS pct_industry
FROM place p LEFT JOIN med ON med.city = p.city GROUP BY p.city, p.region""")
def city_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    places = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    located = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("city"), F.col("r_name").alias("region"), "c_acctbal", "c_mktsegment")
    middle = quantiles(located.where(F.col("c_acctbal") >= 0), ["city"], "c_acctbal", [Quantile("m")]).withColumnRenamed("n", "n_balance")
    industry = flag(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    total = customer.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = share_of_total(located, ["city", "region"],
                         [percent(F.sum(industry), F.count(industry)).alias("pct_industry")], total)
    return out.join(middle, "city", "left").select(
        "city", "region", "n", "share_pct", round_half_up(F.col("m"), 2).alias("median_balance"),
        F.coalesce(F.col("n_balance"), F.lit(0)).alias("n_balance"), "pct_industry")


@query("sector_summary", f"""
WITH med AS (SELECT c_mktsegment, AVG(v) AS m FROM {ranked('customer', 'c_mktsegment', 'c_acctbal')}
             WHERE {MIDDLE} GROUP BY c_mktsegment)
SELECT c.c_mktsegment AS sector, COUNT(*) AS n, {pct('COUNT(*)', '(SELECT COUNT(*) FROM customer)', 2)} AS share_pct,
       {half_up('MAX(med.m)', 2)} AS median_balance,
       {pct("COUNT(*) FILTER (WHERE c.c_acctbal < 0)", "COUNT(*)")} AS pct_in_debt
FROM customer c LEFT JOIN med ON med.c_mktsegment = c.c_mktsegment GROUP BY c.c_mktsegment""")
def sector_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    debt = flag(F.col("c_acctbal") < 0)
    total = customer.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = share_of_total(customer, ["c_mktsegment"], [percent(F.sum(debt), F.count(debt)).alias("pct_in_debt")], total)
    middle = quantiles(customer, ["c_mktsegment"], "c_acctbal", [Quantile("m")]).drop("n")
    return out.join(middle, "c_mktsegment", "left").select(
        F.col("c_mktsegment").alias("sector"), "n", "share_pct", round_half_up(F.col("m"), 2).alias("median_balance"),
        "pct_in_debt")


def brand_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge order x brand, unique. Brands are a closed catalogue; the part table is broadcast only if small."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("o_orderkey"), "p_brand").dropDuplicates()


_BRANDS = """links AS (SELECT DISTINCT l_orderkey AS o_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query("skills_by_role_total", f"""
WITH {_BRANDS},
totals AS (SELECT o_orderpriority AS role, false AS is_total, COUNT(*) AS base FROM orders GROUP BY 1
           UNION ALL SELECT 'Tous', true, COUNT(*) FROM orders),
counts AS (SELECT o_orderpriority AS role, false AS is_total, p_brand, COUNT(*) AS n
           FROM links JOIN orders USING (o_orderkey) GROUP BY 1, 3
           UNION ALL SELECT 'Tous', true, p_brand, COUNT(*) FROM links JOIN orders USING (o_orderkey) GROUP BY p_brand)
SELECT c.role, c.is_total, c.p_brand, c.n, t.base, {pct('c.n', 't.base')} AS share_pct,
       RANK() OVER (PARTITION BY c.role ORDER BY c.n DESC) AS rank
FROM counts c JOIN totals t USING (role)""")
def skills_by_role_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("role"))
    cited = brand_links(spark, sf_dir).join(orders, "o_orderkey")
    counts = with_grand_total(cited, "role", ["p_brand"], "Tous", F.count(F.lit(1)))
    bases = with_grand_total(orders, "role", [], "Tous", F.count(F.lit(1)), "base")
    out = counts.join(bases, ["role", "is_total"]).withColumn("share_pct", percent(F.col("n"), F.col("base")))
    return rank_within(out, ["role", "is_total"], [F.desc("n")])


@query("skill_premium", f"""
WITH {_BRANDS},
measured AS (SELECT o_orderkey, o_totalprice AS price FROM orders),
grid AS (SELECT b.p_brand, m.price, CASE WHEN l.o_orderkey IS NULL THEN 0 ELSE 1 END AS has
         FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN measured m
         LEFT JOIN links l ON l.p_brand = b.p_brand AND l.o_orderkey = m.o_orderkey),
med AS (SELECT p_brand, has, AVG(v) AS median, MAX(cnt) AS n FROM {ranked('grid', 'p_brand, has', 'price')}
        WHERE {MIDDLE} GROUP BY p_brand, has)
SELECT w.p_brand, w.n AS n_with, wo.n AS n_without, {half_up('w.median', 0)} AS median_with,
       {half_up('wo.median', 0)} AS median_without, {half_up('w.median - wo.median', 0)} AS premium,
       {half_up('100 * (w.median - wo.median) / wo.median', 1)} AS premium_pct
FROM med w JOIN med wo ON wo.p_brand = w.p_brand AND wo.has = 0 WHERE w.has = 1 AND w.n >= 10""")
def skill_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"))
    return premium(orders, brand_links(spark, sf_dir), "o_orderkey", "p_brand", "price")


@query("skill_pairs_lift", f"""
WITH {_BRANDS}, freq AS (SELECT p_brand, COUNT(*) AS n FROM links GROUP BY p_brand),
pairs AS (SELECT a.p_brand AS item_a, b.p_brand AS item_b, COUNT(*) AS n FROM links a
          JOIN links b ON a.o_orderkey = b.o_orderkey AND a.p_brand < b.p_brand GROUP BY 1, 2 HAVING COUNT(*) >= 5)
SELECT item_a, item_b, p.n, {pct('p.n', 'fa.n')} AS pct_a_with_b,
       {half_up('CAST(p.n AS DOUBLE) * (SELECT COUNT(*) FROM orders) / (fa.n * fb.n)', 2)} AS lift
FROM pairs p JOIN freq fa ON fa.p_brand = item_a JOIN freq fb ON fb.p_brand = item_b""")
def skill_pairs_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    return pair_lift(brand_links(spark, sf_dir), "o_orderkey", "p_brand", total)


@query("monthly_trend", f"""
SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, o_orderpriority, COUNT(*) AS n,
       {_sql_mean('o_totalprice')} AS mean_price, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_open
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2""")
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate").isNotNull())
    return orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), _mean("o_totalprice").alias("mean_price"),
        F.sum(flag(F.col("o_orderstatus") == "O")).alias("n_open"))


@query("share_in_group", f"""
SELECT user_id, event_type, COUNT(*) AS n,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY user_id)')} AS share_pct
FROM events GROUP BY user_id, event_type""")
def share_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_within(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query("seniority_order_share", f"""
SELECT o_orderstatus, o_orderpriority, CAST(LEFT(o_orderpriority, 1) AS INTEGER) AS weight, COUNT(*) AS n,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY o_orderstatus)')} AS share_pct
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def seniority_order_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = share_within(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority")
    weight = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2) \
        .when(F.col("o_orderpriority") == "3-MEDIUM", 3).when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 4) \
        .otherwise(5)
    return shares.withColumn("weight", weight)


@query("contract_mix", f"""
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n,
       {_sql_mean("CASE WHEN o_totalprice > 250000 THEN o_totalprice END")} AS mean_large
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def contract_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    large = orders.withColumn("large", F.when(F.col("o_totalprice") > 250000, F.col("o_totalprice")))
    return large.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), _mean("large").alias("mean_large"))


@query("links_per_order", f"""
WITH {_BRANDS} SELECT o.o_orderkey, CAST(COUNT(l.p_brand) AS BIGINT) AS skills_count,
       COALESCE(STRING_AGG(l.p_brand, ', ' ORDER BY l.p_brand), '') AS skills
FROM orders o LEFT JOIN links l USING (o_orderkey) GROUP BY o.o_orderkey""")
def links_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-basket count with a 0 default and the sorted item list as text."""
    sets = brand_links(spark, sf_dir).groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("skills_count"),
        F.array_join(F.array_sort(F.collect_set("p_brand")), ", ").alias("skills"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(sets, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("skills_count", F.lit(0)).alias("skills_count"),
        F.coalesce("skills", F.lit("")).alias("skills"))


@query("labelled_links", f"""
WITH {_BRANDS}, catalogue AS (SELECT p_brand, MIN(p_type) AS category FROM part GROUP BY p_brand)
SELECT l.o_orderkey, l.p_brand, c.category,
       CASE WHEN c.category = 'ECONOMY' THEN 'Technologie' ELSE 'Compétence / méthode' END AS kind
FROM links l JOIN catalogue c USING (p_brand)""")
def labelled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_type").alias("category"))
    kind = F.when(F.col("category") == "ECONOMY", F.lit("Technologie")).otherwise(F.lit("Compétence / méthode"))
    return brand_links(spark, sf_dir).join(catalogue, "p_brand").withColumn("kind", kind)


@query("weighted_median_mean", f"""
WITH cells AS (SELECT o_orderpriority, o_orderstatus, ROUND(AVG(v) FILTER (WHERE {MIDDLE})) AS m, MAX(cnt) AS n
               FROM {ranked('orders', 'o_orderpriority, o_orderstatus', 'o_totalprice')} GROUP BY 1, 2)
SELECT o_orderpriority, {half_up('SUM(m * n) / SUM(n)', 4)} AS mean_of_medians FROM cells GROUP BY o_orderpriority""")
def weighted_median_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = quantiles(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice",
                      [Quantile("m")])
    out = weighted_mean(cells.withColumn("m", F.round("m")), ["o_orderpriority"], "m", "n", "mean_of_medians")
    return out.withColumn("mean_of_medians", round_half_up(F.col("mean_of_medians"), 4))


@query("share_sum_by_role", f"""
WITH s AS (SELECT o_orderpriority, o_orderstatus, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY o_orderpriority)')} AS p
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, {half_up("SUM(p)", 4)} AS share_pct FROM s WHERE o_orderstatus IN ('F', 'P')
GROUP BY o_orderpriority ORDER BY share_pct DESC""")
def share_sum_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = share_within(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus")
    summed = shares.where(F.col("o_orderstatus").isin("F", "P")).groupBy("o_orderpriority").agg(
        round_half_up(F.sum("share_pct"), 4).alias("share_pct"))
    return summed.orderBy(F.desc("share_pct"))


@query("conditional_medians", f"""
WITH area AS (SELECT o_totalprice AS price, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN 'capital'
              WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'regions' END AS area FROM orders),
med AS (SELECT area, AVG(v) AS m, MAX(cnt) AS n FROM {ranked('(SELECT * FROM area WHERE area IS NOT NULL)', 'area', 'price')}
        WHERE {MIDDLE} GROUP BY area)
SELECT area, n, {half_up('m', 2)} AS median,
       (SELECT {pct("COUNT(*) FILTER (WHERE o_orderstatus = 'F')", "COUNT(*)", 4)} FROM area
        WHERE area IS DISTINCT FROM 'capital') AS pct_done_outside,
       (SELECT {pct("COUNT(*) FILTER (WHERE area = 'capital')", "COUNT(*)", 4)} FROM area) AS capital_share
FROM med""")
def conditional_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("capital")) \
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.lit("regions"))
    orders = table(spark, sf_dir, "orders").withColumn("area", area)
    middle = quantiles(orders.where(F.col("area").isNotNull()), ["area"], "o_totalprice", [Quantile("median")])
    done = flag(F.col("o_orderstatus") == "F")
    outside = orders.where(~F.col("area").eqNullSafe("capital")).agg(
        percent(F.sum(done), F.count(done), 4).alias("x")).scalar()
    capital = orders.agg(percent(F.count_if(F.col("area") == "capital"), F.count(F.lit(1)), 4).alias("x")).scalar()
    return middle.withColumn("median", round_half_up(F.col("median"), 2)) \
        .withColumns({"pct_done_outside": outside, "capital_share": capital})


@query("share_citing_any", f"""
WITH {_BRANDS}, hit AS (SELECT DISTINCT o_orderkey FROM links WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
SELECT o_orderpriority, COUNT(*) AS n, COUNT(h.o_orderkey) AS n_citing, {pct('COUNT(h.o_orderkey)', 'COUNT(*)', 4)} AS share_pct
FROM orders o LEFT JOIN hit h USING (o_orderkey) GROUP BY o_orderpriority""")
def share_citing_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = brand_links(spark, sf_dir).where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    hit = cited.select("o_orderkey").distinct().withColumn("hit", F.lit(1))
    orders = table(spark, sf_dir, "orders").join(hit, "o_orderkey", "left")
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count("hit").alias("n_citing"),
        percent(F.count("hit"), F.count(F.lit(1)), 4).alias("share_pct"))


@query("semi_join_orders", f"""
WITH {_BRANDS} SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT o_orderkey FROM links WHERE p_brand IN ('Brand#7', 'Brand#9'))""")
def semi_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = brand_links(spark, sf_dir).where(F.col("p_brand").isin("Brand#7", "Brand#9"))
    return table(spark, sf_dir, "orders").join(cited, "o_orderkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("anti_join_customers", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def anti_join_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("role_volume_max", f"""
WITH {_BRANDS}, base AS (SELECT o_orderpriority, p_brand, COUNT(*) AS n FROM links JOIN orders USING (o_orderkey) GROUP BY 1, 2)
SELECT o_orderpriority, MAX(n) AS n FROM base GROUP BY o_orderpriority""")
def role_volume_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    base = brand_links(spark, sf_dir).join(orders, "o_orderkey").groupBy("o_orderpriority", "p_brand").count()
    return base.groupBy("o_orderpriority").agg(F.max("count").alias("n"))


@query("top_values", """
SELECT p_name, COUNT(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 20""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "part"), "p_name", 20)


@query("top_customers", """
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       ROW_NUMBER() OVER (ORDER BY SUM(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_custkey) AS rank
FROM orders GROUP BY o_custkey ORDER BY rank LIMIT 10""")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(_cents("o_totalprice")).alias("total"))
    best = top_n(totals, [F.desc("total"), F.asc("o_custkey")], 10)
    return best.withColumn("total", F.col("total").cast("double"))


@query("top_orders_per_segment", """
SELECT c_mktsegment, o_orderkey, o_totalprice, rank FROM (
  SELECT c_mktsegment, o_orderkey, o_totalprice,
         ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rank <= 6""")
def top_orders_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customer, "o_custkey")
    return top_n_per_group(orders, ["c_mktsegment"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 6) \
        .select("c_mktsegment", "o_orderkey", "o_totalprice", "rank")


@query("rank_with_ties", """
SELECT user_id, event_type, n, RANK() OVER (PARTITION BY event_type ORDER BY n DESC) AS rank
FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)""")
def rank_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rank_by(counted, ["event_type"], "n").select("user_id", "event_type", "n", "rank")


@query("seeded_sample", """
SELECT o_orderkey, o_orderpriority FROM orders ORDER BY MD5(CONCAT(o_orderkey, ':0')), o_orderkey LIMIT 15""")
def sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", 15)


@query("histogram", """
SELECT CAST(LEAST(FLOOR((o_totalprice - 20000) / 20000) * 20000 + 20000, 380000) AS DOUBLE) AS bin_start, COUNT(*) AS n
FROM orders WHERE o_totalprice BETWEEN 20000 AND 400000 GROUP BY 1""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_bins(table(spark, sf_dir, "orders"), "o_totalprice", 20000.0, 400000.0, 20000.0)


@query("box_plot", f"""
SELECT c_mktsegment, COUNT(*) AS n, {half_up('QUANTILE_CONT(c_acctbal, 0.25)', 4)} AS q1,
       {half_up('QUANTILE_CONT(c_acctbal, 0.5)', 4)} AS median, {half_up('QUANTILE_CONT(c_acctbal, 0.75)', 4)} AS q3,
       MIN(c_acctbal) AS low, MAX(c_acctbal) AS high FROM customer GROUP BY c_mktsegment""")
def box_plot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    box = quantiles(customer, ["c_mktsegment"], "c_acctbal", BOX)
    box = box.withColumns({q.name: round_half_up(F.col(q.name), 4) for q in BOX})
    ends = customer.groupBy("c_mktsegment").agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    return box.join(ends, "c_mktsegment")


@query("pivot_median", f"""
WITH cells AS (SELECT o_orderpriority, o_orderstatus, MAX(cnt) AS n, AVG(v) FILTER (WHERE {MIDDLE}) AS m
               FROM {ranked("(SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O'))",
                            'o_orderpriority, o_orderstatus', 'o_totalprice')} GROUP BY 1, 2)
SELECT o_orderpriority, MAX(CASE WHEN o_orderstatus = 'F' AND n >= 100 THEN m END) AS "F_median",
       MAX(CASE WHEN o_orderstatus = 'F' THEN n END) AS "F_n",
       MAX(CASE WHEN o_orderstatus = 'O' AND n >= 100 THEN m END) AS "O_median",
       MAX(CASE WHEN o_orderstatus = 'O' THEN n END) AS "O_n",
       {half_up('AVG(CASE WHEN n >= 100 THEN m END)', 4)} AS row_mean
FROM cells GROUP BY o_orderpriority""")
def pivot_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = median_matrix(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O"],
                        "o_totalprice", minimum=100)
    return out.withColumn("row_mean", round_half_up(F.col("row_mean"), 4))


@query("pivot_share", f"""
WITH {_BRANDS}, best AS (SELECT p_brand, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_brand) AS rank
                         FROM links GROUP BY p_brand QUALIFY rank <= 12),
base AS (SELECT o_orderstatus, COUNT(*) AS base FROM orders GROUP BY 1),
cells AS (SELECT p_brand, o_orderstatus, COUNT(*) AS n FROM links JOIN orders USING (o_orderkey) GROUP BY 1, 2),
shares AS (SELECT p_brand, o_orderstatus, {pct('n', 'base')} AS p FROM cells JOIN base USING (o_orderstatus))
SELECT b.p_brand, b.rank, COALESCE(MAX(CASE WHEN o_orderstatus = 'F' THEN p END), 0) AS "F",
       COALESCE(MAX(CASE WHEN o_orderstatus = 'O' THEN p END), 0) AS "O",
       COALESCE(MAX(CASE WHEN o_orderstatus = 'P' THEN p END), 0) AS "P"
FROM best b LEFT JOIN shares s USING (p_brand) GROUP BY b.p_brand, b.rank""")
def pivot_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each state's orders citing the twelve most cited brands, absent cells 0."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    cited = brand_links(spark, sf_dir)
    best = top_n(cited.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("p_brand")], 12)
    base = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("base"))
    cells = cited.join(orders, "o_orderkey").groupBy("p_brand", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    shares = cells.join(base, "o_orderstatus").withColumn("p", percent(F.col("n"), F.col("base")))
    wide = shares.groupBy("p_brand").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("p")).na.fill(0.0)
    return best.select("p_brand", "rank").join(wide, "p_brand")


@query("crosstab", f"""
SELECT user_id, {pct("COUNT(*) FILTER (WHERE event_type = 'view')", 'COUNT(*)', 4)} AS "view",
       {pct("COUNT(*) FILTER (WHERE event_type = 'click')", 'COUNT(*)', 4)} AS "click",
       {pct("COUNT(*) FILTER (WHERE event_type = 'purchase')", 'COUNT(*)', 4)} AS "purchase",
       CAST(0 AS DOUBLE) AS "never"
FROM events GROUP BY user_id""")
def crosstab_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstab(table(spark, sf_dir, "events"), "user_id", "event_type", ["view", "click", "purchase", "never"])


@query("quality_profile", f"""
WITH o AS (SELECT *, COUNT(*) OVER () AS n FROM orders)
SELECT 'open' AS indicator, {pct("COUNT(*) FILTER (WHERE o_orderstatus = 'O')", 'COUNT(*)')} AS part_pct FROM o
UNION ALL SELECT 'unspecified', {pct("COUNT(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED')", 'COUNT(*)')} FROM o
UNION ALL SELECT 'cheap', {pct("COUNT(*) FILTER (WHERE o_totalprice < 18000)", 'COUNT(*)')} FROM o
UNION ALL SELECT 'undated', {pct("COUNT(*) FILTER (WHERE o_orderdate IS NULL)", 'COUNT(*)')} FROM o""")
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(table(spark, sf_dir, "orders"), {
        "open": F.col("o_orderstatus") == "O", "unspecified": F.col("o_orderpriority") == "4-NOT SPECIFIED",
        "cheap": F.col("o_totalprice") < 18000, "undated": F.col("o_orderdate").isNull()})


@query("junior_share", f"""
SELECT c_mktsegment, {pct("COUNT(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))", "COUNT(*)", 4)} AS junior_pct
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def junior_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    hit = flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    joined = table(spark, sf_dir, "orders").join(customer, "o_custkey")
    return joined.groupBy("c_mktsegment").agg(percent(F.sum(hit), F.count(hit), 4).alias("junior_pct"))


@query("constraints_report", """
SELECT 'orders' AS "table", 'primary key (o_orderkey)' AS rule, COUNT(*) AS violations
FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'lineitem', 'primary key (l_orderkey, l_linenumber)', COUNT(*)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
UNION ALL SELECT 'orders', 'foreign key (o_custkey)', COUNT(*) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'lineitem', 'foreign key (l_partkey)', COUNT(*) FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
UNION ALL SELECT 'orders', 'o_orderkey not null', COUNT(*) FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'orders', 'o_orderpriority not null', COUNT(*) FROM orders WHERE o_orderpriority IS NULL
UNION ALL SELECT 'orders', 'status in (F, O)', COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def constraints_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    rules = checks.not_null("o_orderkey", "o_orderpriority")
    rules["status in (F, O)"] = F.col("o_orderstatus").isin("F", "O")
    return checks.report(
        checks.primary_key(orders, "orders", ["o_orderkey"]),
        checks.primary_key(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        checks.foreign_key(orders, "orders", "o_custkey", table(spark, sf_dir, "customer"), "c_custkey"),
        checks.foreign_key(lines, "lineitem", "l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
        checks.column_rules(orders, "orders", rules))


@query("sliced_orders", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders
WHERE o_orderstatus IN ('F', 'P') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
GROUP BY o_orderpriority""")
def sliced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from offerscope.operators.filters import slice_offers

    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority"), F.col("o_orderstatus").alias("contract_type"),
        F.col("o_orderdate").cast("date").alias("published_date"))
    kept = slice_offers(orders, contracts=["F", "P"], since=date(1996, 1, 1), until=date(1999, 12, 31))
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
