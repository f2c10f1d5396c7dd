"""One query per operator, on columns of the given tables that play its role.

Entities are orders and customers, regions come from nation and region, words
of p_name are a multi-select, line item measures a wide block, years of
o_orderdate the editions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions import missing as m
from canvass.functions import text as t
from canvass.functions.local import local_table
from canvass.operators import aggregate as a
from canvass.operators import catalog as c
from canvass.operators import clean, joins, partials, privacy, ranges, reshape, sets, windows
from canvass.operators.proposals import propose
from canvass.plans import combine, trends
from canvass.sources import editions, forms

from .registry import query, table

WORD_LABELS = {"red": "Rot", "blue": "Blau", "green": "Grün", "small": "Klein", "large": "Groß"}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def orders_with_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(
        nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")
    )


def placed_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders_with_year(spark, sf).join(
        customers(spark, sf), F.col("o_custkey") == F.col("c_custkey")
    )


PLACED = """orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


# ---------------------------------------------------------------- reshaping


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def multiselect_long(spark, sf):
    return reshape.multiselect_long(table(spark, sf, "part"), "p_name", ["p_partkey"], "word")


@query("""
WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS code FROM part),
l AS (SELECT CASE code WHEN 'red' THEN 'Rot' WHEN 'blue' THEN 'Blau' WHEN 'green' THEN 'Grün'
      WHEN 'small' THEN 'Klein' WHEN 'large' THEN 'Groß' END AS word FROM w)
SELECT word, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS share FROM l GROUP BY word
""")
def multiselect_share(spark, sf):
    parts = table(spark, sf, "part")
    words = reshape.multiselect_long(parts, "p_name", ["p_partkey"], "word")
    return a.share(joins.recode(words, WORD_LABELS, "word"), "word", a.all_rows(parts))


MEASURES = ["l_quantity", "l_discount", "l_tax"]


def measures_with_gaps(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )


UNPIVOT = """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS col_name, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', nullif(l_discount, 0) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', nullif(l_tax, 0) FROM lineitem
"""


@query(f"SELECT * FROM ({UNPIVOT}) WHERE value IS NOT NULL")
def unpivot_measures(spark, sf):
    return reshape.columns_long(
        measures_with_gaps(spark, sf), MEASURES, "value", ["l_orderkey", "l_linenumber"]
    )


@query(UNPIVOT)
def unpivot_keep_null(spark, sf):
    return reshape.columns_long(
        measures_with_gaps(spark, sf), MEASURES, "value", ["l_orderkey", "l_linenumber"], keep_null=True
    )


@query("""
SELECT l_orderkey, l_linenumber, 'Menge' AS item, 'Stück' AS unit, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'Rabatt', 'Anteil', l_discount FROM lineitem WHERE l_discount <> 0
UNION ALL SELECT l_orderkey, l_linenumber, 'Steuer', 'Anteil', l_tax FROM lineitem WHERE l_tax <> 0
""")
def labelled_long(spark, sf):
    labels = [
        ("l_quantity", {"item": "Menge", "unit": "Stück"}),
        ("l_discount", {"item": "Rabatt", "unit": "Anteil"}),
        ("l_tax", {"item": "Steuer", "unit": "Anteil"}),
    ]
    return reshape.labelled_long(measures_with_gaps(spark, sf), labels, ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, 'menge' AS item, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'rabatt', l_discount FROM lineitem
""")
def wide_rename_long(spark, sf):
    ids = ["l_orderkey", "l_linenumber"]
    block = reshape.rename_block(
        table(spark, sf, "lineitem"), {"l_quantity": "menge", "l_discount": "rabatt"}, ids
    )
    return reshape.columns_long(block, ["menge", "rabatt"], "value", ids, "item", keep_null=True)


BRANDS = [f"Brand#{i}" for i in range(1, 27)]


@query(
    "SELECT p_size, "
    + ", ".join(f"max(CASE WHEN p_brand = '{b}' THEN 1 ELSE 0 END) AS \"{b}\"" for b in BRANDS)
    + " FROM part GROUP BY p_size"
)
def presence_matrix(spark, sf):
    return reshape.presence_matrix(table(spark, sf, "part"), "p_size", "p_brand", BRANDS)


@query(f"""
WITH b AS (SELECT unnest([{', '.join(repr(b) for b in BRANDS)}]) AS brand),
s AS (SELECT DISTINCT p_size FROM part),
h AS (SELECT DISTINCT p_size, p_brand FROM part)
SELECT s.p_size, brand, CASE WHEN h.p_brand IS NULL THEN 0 ELSE 1 END AS has,
  CASE WHEN h.p_brand IS NULL THEN '✗' ELSE '✓' END AS label
FROM s CROSS JOIN b LEFT JOIN h ON h.p_size = s.p_size AND h.p_brand = b.brand
""")
def matrix_roundtrip(spark, sf):
    wide = reshape.presence_matrix(table(spark, sf, "part"), "p_size", "p_brand", BRANDS)
    return reshape.matrix_long(wide, "p_size", BRANDS, "brand")


@query(f"""
WITH c AS (SELECT r_name, o_orderpriority AS level, count(*) AS n FROM {PLACED}
  WHERE o_orderstatus = 'F' GROUP BY ALL),
l AS (SELECT unnest(['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW','6-NEVER']) AS level)
SELECT r.r_name, l.level, coalesce(c.n, 0)::BIGINT AS n
FROM region r CROSS JOIN l LEFT JOIN c ON c.r_name = r.r_name AND c.level = l.level
""")
def all_levels_zero(spark, sf):
    done = placed_orders(spark, sf).filter("o_orderstatus = 'F'")
    n = a.counts(done.withColumnRenamed("o_orderpriority", "level"), ["r_name", "level"])
    return reshape.complete(
        n, ["r_name"], "level", [*PRIORITIES, "6-NEVER"], groups=table(spark, sf, "region")
    )


@query("""
SELECT s.o_orderstatus, p.o_orderpriority FROM (SELECT DISTINCT o_orderstatus FROM orders) s
CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
""")
def cross_grid(spark, sf):
    o = table(spark, sf, "orders")
    return reshape.grid(o.select("o_orderstatus"), o.select("o_orderpriority"))


@query("""
WITH c AS (SELECT nullif(p_type, 'PROMO') AS p_type, count(*) AS n FROM part GROUP BY 1),
l AS (SELECT unnest(['ECONOMY','LARGE','MEDIUM','NEU']) AS p_type)
SELECT p_type, sum(n)::BIGINT AS n FROM (SELECT * FROM c UNION ALL SELECT p_type, 0 FROM l) GROUP BY p_type
""")
def levels_padded(spark, sf):
    parts = table(spark, sf, "part").withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return reshape.complete_levels(a.counts(parts, "p_type"), "p_type", ["ECONOMY", "LARGE", "MEDIUM", "NEU"])


# -------------------------------------------------------------------- joins


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fertig' WHEN 'O' THEN 'offen' END AS o_orderstatus
FROM orders
""")
def recode_left(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.recode(o, {"F": "fertig", "O": "offen"}, "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, p_name AS l_partkey FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def recode_by_table(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("label"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.recode(lines, parts, "l_partkey")


@query("""
WITH w AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT p_partkey, word, CASE WHEN word = 'red' THEN nullif(p_type, 'PROMO') END AS other FROM w
""")
def other_text_attach(spark, sf):
    parts = table(spark, sf, "part").withColumn("text", F.nullif("p_type", F.lit("PROMO")))
    options = reshape.multiselect_long(parts, "p_name", ["p_partkey"], "word")
    return joins.attach_other(options, parts, ["p_partkey"], "word", "red", "text", "other")


@query("""
WITH w AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT p_partkey, word, CASE WHEN word = 'red' THEN p_type END AS other FROM w
""")
def other_text_same_row(spark, sf):
    return joins.multiselect_with_other(
        table(spark, sf, "part"), "p_name", "p_type", ["p_partkey"], "word", "other", "red"
    )


PATTERNS = {"^re": "anfang", "b(o|l)": "mitte", "ring": "ende", "zzz": "nie"}


@query("""
SELECT p_partkey, p_name, name, label FROM part
JOIN (VALUES ('^re', 'anfang'), ('b(o|l)', 'mitte'), ('ring', 'ende'), ('zzz', 'nie')) AS v(name, label)
ON regexp_matches(p_name, v.name)
""")
def regex_join(spark, sf):
    return joins.regex_join(table(spark, sf, "part").select("p_partkey", "p_name"), PATTERNS, "p_name")


@query(f"""
SELECT r_name, n_name, count(*) AS n, count(DISTINCT c_mktsegment) AS n_segments, round(sum(c_acctbal), 2) AS acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
""")
def region_rollup(spark, sf):
    return customers(spark, sf).rollup("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("c_mktsegment").alias("n_segments"),
        F.round(F.sum("c_acctbal"), 2).alias("acctbal"),
    )


@query("""
SELECT c_custkey, c_mktsegment AS og_region, CASE c_mktsegment WHEN 'BUILDING' THEN 'Haus' WHEN 'FURNITURE' THEN 'Haus'
  WHEN 'HOUSEHOLD' THEN 'Heim' END AS region_grouped FROM customer
""")
def region_map(spark, sf):
    regions = local_table(
        spark, [("BUILDING", "Haus"), ("FURNITURE", "Haus"), ("HOUSEHOLD", "Heim")],
        "og_region string, region_grouped string",
    )
    who = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("og_region"))
    return joins.map_region(who, regions)


@query("""
SELECT c_mktsegment, count(*) AS count FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE') GROUP BY 1
""")
def unmapped_report(spark, sf):
    known = local_table(spark, [("BUILDING",), ("FURNITURE",)], "og_region string")
    return joins.unmapped(table(spark, sf, "customer"), known, "c_mktsegment", "og_region")


@query("""
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS raw FROM customer),
d AS (SELECT raw AS og_name_orig, coalesce(raw, 'ohne') AS og_name, count(*) AS og_region FROM c GROUP BY raw)
SELECT c_custkey, raw, og_name, og_region FROM c JOIN d ON raw IS NOT DISTINCT FROM og_name_orig
""")
def null_safe_join(spark, sf):
    who = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("raw")
    )
    spelling = who.groupBy(F.col("raw").alias("og_name_orig")).agg(
        F.coalesce(F.first("raw"), F.lit("ohne")).alias("og_name"), F.count(F.lit(1)).alias("og_region")
    )
    return joins.harmonize(who, spelling, "raw")


@query("SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def semi_filter(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return joins.keep_ids(
        table(spark, sf, "lineitem"), done.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"
    )


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS k FROM customer)
SELECT c_custkey, k FROM c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.k AND o_totalprice > 400000)
""")
def anti_filter_null(spark, sf):
    who = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("k"), "c_custkey"
    )
    known = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    return joins.drop_known(who, known, "k")


@query("""
SELECT o_custkey AS custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def natural_inner(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    right = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.natural_join(left, right)


@query("""
WITH l AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
r AS (SELECT o_custkey, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders
      WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT l.*, r.n AS n_lookup, r.top FROM l LEFT JOIN r USING (o_custkey, o_orderpriority)
""")
def composite_left_join(spark, sf):
    o = table(spark, sf, "orders")
    keys = ["o_custkey", "o_orderpriority"]
    done = o.filter("o_orderstatus = 'F'").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")
    )
    return joins.suffixed_join(a.counts(o, keys), done, keys)


@query("""
WITH t AS (SELECT c_nationkey AS k, count(*) AS anzahl FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, count(*) AS gruppen FROM supplier GROUP BY 1),
g AS (SELECT c_nationkey AS k, CASE WHEN count(*) >= 3 THEN round_even(avg(10 + c_custkey % 60), 0) END AS avg_alter,
      count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
SELECT t.k, anzahl, gruppen, avg_alter, n FROM t LEFT JOIN s USING (k) LEFT JOIN g USING (k)
""")
def summary_chain(spark, sf):
    who = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "k")
    with_supply = a.counts(table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "k"), "k", "gruppen")
    ages = a.group_mean_suppressed(
        who.filter("c_mktsegment = 'BUILDING'").withColumn("alter", 10 + F.col("c_custkey") % 60), "k", "alter", "avg_alter"
    )
    return joins.lookup(joins.lookup(a.counts(who, "k", "anzahl"), with_supply, "k"), ages, "k")


# -------------------------------------------------------------- aggregation


@query("""
SELECT p_brand, count(v) AS total_non_na, avg(v) AS average, count(*) FILTER (v > 3) AS zustimmung,
  count(*) FILTER (v > 3) / count(v) AS zustimmung_perc
FROM (SELECT p_brand, CASE WHEN p_size % 7 <> 0 THEN 1 + p_size % 6 END AS v FROM part) GROUP BY p_brand
""")
def likert_summary(spark, sf):
    v = F.when(F.col("p_size") % 7 != 0, (1 + F.col("p_size") % 6).cast("string"))
    return a.likert_summary(table(spark, sf, "part").withColumn("value", v), "p_brand")


@query("""
SELECT o_orderpriority AS aussage, 1 + o_orderkey % 6 AS value, count(*) AS n,
  count(*) / (SELECT count(DISTINCT o_custkey) FROM orders) AS share
FROM orders GROUP BY ALL
""")
def likert_distribution(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("aussage"), (1 + F.col("o_orderkey") % 6).alias("value"), "o_custkey"
    )
    return a.share(o, ["aussage", "value"], a.respondents(o, "o_custkey"))


BANDS = "floor(c_acctbal / 1000)::BIGINT"


@query(f"""
SELECT c_nationkey, c_mktsegment, {BANDS} AS band,
  CASE WHEN count(*) >= 3 THEN round_even(avg(10 + c_custkey % 60), 0) END AS avg_alter, count(*) AS n
FROM customer GROUP BY ALL
""")
def group_age_suppressed(spark, sf):
    who = table(spark, sf, "customer").withColumns(
        {"band": F.floor(F.col("c_acctbal") / 1000), "alter": 10 + F.col("c_custkey") % 60}
    )
    return a.group_mean_suppressed(who, ["c_nationkey", "c_mktsegment", "band"], "alter", "avg_alter")


@query(f"""
WITH g AS (SELECT c_nationkey, c_mktsegment, {BANDS} AS band,
  CASE WHEN count(*) >= 3 THEN round_even(avg(10 + c_custkey % 60), 0) END AS v, count(*) AS n
  FROM customer GROUP BY ALL)
SELECT c_nationkey, sum(v * n) / sum(CASE WHEN v IS NOT NULL THEN n END) AS avg_alter FROM g GROUP BY 1
""")
def weighted_mean(spark, sf):
    return group_age_suppressed(spark, sf).groupBy("c_nationkey").agg(
        a.weighted_mean("avg_alter", "n").alias("avg_alter")
    )


COMBINED = """
WITH og AS (SELECT 2000 AS year, nullif(c_mktsegment, 'HOUSEHOLD') AS region_grouped, c_nationkey::VARCHAR AS og_region,
    c_name AS og_name, 5 AS anzahl_insg, 4 AS anzahl_tn, 1 AS anzahl_ma_leitung FROM customer WHERE c_acctbal > 5000),
tn AS (SELECT 2000 AS year, nullif(c_mktsegment, 'HOUSEHOLD') AS region_grouped, c_nationkey::VARCHAR AS og_region,
    nullif(c_name, 'Customer#000000007') AS og_name, nullif(o_orderstatus, 'P') AS v
    FROM orders JOIN customer ON o_custkey = c_custkey),
only_tn AS (SELECT year, coalesce(region_grouped, 'keine Angabe') AS region_grouped, og_region,
    coalesce(og_name, 'keine Angabe') AS og_name, count(*) AS anzahl_insg,
    count(*) FILTER (v IS DISTINCT FROM 'F') AS anzahl_tn, count(*) FILTER (v = 'F') AS anzahl_ma_leitung
    FROM tn WHERE NOT EXISTS (SELECT 1 FROM og WHERE og.og_name = tn.og_name) GROUP BY ALL)
SELECT * FROM og UNION ALL BY NAME SELECT * FROM only_tn
"""


@query(COMBINED)
def combined_totals(spark, sf):
    who = table(spark, sf, "customer").select(
        "c_custkey", F.lit(2000).alias("year"),
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("region_grouped"),
        F.col("c_nationkey").cast("string").alias("og_region"),
        F.col("c_name").alias("og_name"), "c_acctbal",
    )
    groups = who.filter("c_acctbal > 5000").withColumns(
        {"anzahl_insg": F.lit(5), "anzahl_tn": F.lit(4), "anzahl_ma_leitung": F.lit(1)}
    )
    people = table(spark, sf, "orders").join(who, F.col("o_custkey") == F.col("c_custkey")).withColumns(
        {
            "og_name": F.nullif("og_name", F.lit("Customer#000000007")),
            "verantwortung_janein": F.when(F.col("o_orderstatus") == "F", "Ja").when(
                F.col("o_orderstatus") == "O", "Nein"
            ),
        }
    )
    return combine.combined_totals(groups, people)


@query("""
SELECT year(o_orderdate)::INT AS year,
  count(DISTINCT nullif(o_orderpriority, '5-LOW')) + max((o_orderpriority = '5-LOW')::INT) AS n_levels,
  CASE WHEN bool_and(o_totalprice < 499900) THEN count(*) END AS strict_n FROM orders GROUP BY 1
""")
def yearly_counts(spark, sf):
    o = orders_with_year(spark, sf).withColumns(
        {"p": F.nullif("o_orderpriority", F.lit("5-LOW")), "one": F.when(F.col("o_totalprice") < 499900, 1)}
    )
    return trends.yearly(o, {"n_levels": m.n_distinct("p"), "strict_n": m.strict_sum("one")})


@query(f"""
SELECT year(o_orderdate)::INT AS year, r_name, count(DISTINCT c_custkey) AS customers,
  CASE WHEN bool_and(o_totalprice < 499000) THEN count(*) END AS strict_n FROM {PLACED} GROUP BY 1, 2
""")
def yearly_by_region(spark, sf):
    o = placed_orders(spark, sf).withColumn("one", F.when(F.col("o_totalprice") < 499000, 1))
    return trends.yearly(
        o, {"customers": F.count_distinct("c_custkey"), "strict_n": m.strict_sum("one")}, ["r_name"]
    )


@query("SELECT year(o_orderdate)::INT AS year, count(*) FILTER (o_orderstatus = 'F') AS count FROM orders GROUP BY 1")
def yearly_yes(spark, sf):
    o = orders_with_year(spark, sf).withColumn("antwort", F.when(F.col("o_orderstatus") == "F", "Ja"))
    return trends.yes_per_year(o, "antwort")


@query(f"""
WITH p AS (SELECT year(o_orderdate)::INT AS year, nullif(r_name, 'ASIA') AS region_grouped,
  CASE o_orderstatus WHEN 'F' THEN 'Ja' WHEN 'O' THEN 'Nein' END AS x FROM {PLACED})
SELECT year, region_grouped, count(*) FILTER (x = 'Ja') AS anz_ja, count(*) FILTER (x = 'Nein') AS anz_nein,
  count(*) AS anz_total, avg((x = 'Ja')::INT) * 100 AS pct_ja FROM p WHERE region_grouped IS NOT NULL GROUP BY ALL
UNION ALL SELECT year, 'Deutschlandweit', NULL, NULL, NULL,
  round_even(count(*) FILTER (x = 'Ja') * 100 / count(*), 1) FROM p GROUP BY year
""")
def participation_by_region(spark, sf):
    from canvass.plans.network import participation_by_region as report

    people = placed_orders(spark, sf).select(
        "year", F.nullif("r_name", F.lit("ASIA")).alias("region_grouped"),
        F.when(F.col("o_orderstatus") == "F", "Ja").when(F.col("o_orderstatus") == "O", "Nein").alias("x"),
    )
    return report(people, "x")


@query("""
SELECT choice, count(*) FILTER (o_orderstatus = choice AND y = 2000) * 100 / count(*) FILTER (y = 2000) AS pct_2000,
  count(*) FILTER (o_orderstatus = choice AND y = 1999) * 100 / count(*) FILTER (y = 1999) AS pct_1999
FROM (SELECT o_orderstatus, year(o_orderdate) AS y FROM orders), (VALUES ('F'), ('O'), ('X')) AS v(choice) GROUP BY choice
""")
def pct_two_years(spark, sf):
    return a.percent_by_year(orders_with_year(spark, sf), "o_orderstatus", ["F", "O", "X"], [2000, 1999])


@query("""
SELECT round_even(avg(s), 1) AS avg_weekly, round_even(round_even(avg(s), 1) * 52, 0) AS avg_yearly
FROM (SELECT l_orderkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1)
""")
def mean_of_sums(spark, sf):
    out = a.mean_of_sums(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", name="avg_weekly")
    return out.withColumn("avg_yearly", F.bround(F.col("avg_weekly") * 52))


@query("""
SELECT isodow(o_orderdate)::INT AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, day LIMIT 1
""")
def favorite_day(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.weekday("o_orderdate") + 1)
    return a.top_value(o, "day")


@query("""
WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL)
SELECT * FROM c WHERE n = (SELECT max(n) FROM c d WHERE d.c_mktsegment = c.c_mktsegment)
""")
def top_with_ties(spark, sf):
    return a.top_values(a.counts(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"]), "c_mktsegment")


@query("""
WITH t AS (SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
  ELSE o_orderstatus = 'F' AND o_totalprice > 300000 END AS x FROM orders)
SELECT o_custkey, bool_or(x) AS hat FROM t GROUP BY 1 HAVING bool_or(x) OR count(*) = count(x)
""")
def any_three_valued(spark, sf):
    test = F.when(
        F.col("o_orderpriority") != "5-LOW", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)
    )
    return a.any_per_id(table(spark, sf, "orders"), ["o_custkey"], test, "hat")


NEED = """(SELECT p_brand AS bedarf, CASE WHEN p_size % 5 < 4 THEN p_size % 5 END AS v FROM part)"""


@query(f"""
SELECT bedarf, median(v)::DOUBLE AS median_bedarf, round(avg(v), 9) AS bedarf_mean, round(stddev_samp(v), 9) AS sd,
  (max(v) - min(v)) AS range FROM {NEED} GROUP BY bedarf
""")
def item_statistics(spark, sf):
    need = table(spark, sf, "part").select(
        F.col("p_brand").alias("bedarf"), F.when(F.col("p_size") % 5 < 4, F.col("p_size") % 5).alias("v")
    )
    stats = a.item_stats(need, ["bedarf"], "v")
    return stats.withColumns({"bedarf_mean": F.round("bedarf_mean", 9), "sd": F.round("sd", 9)})


NEED_SENTENCE = "CASE " + " ".join(
    f"WHEN bedarf_label = '{need}' AND sd_label = '{spread}' THEN '{text}'" for (need, spread), text in a.NEED_SENTENCES.items()
) + f" ELSE '{a.NOT_ENOUGH}' END"


@query(f"""
WITH s AS (SELECT bedarf, avg(v) AS mw, max(v) - min(v) AS r FROM {NEED} GROUP BY 1),
b AS (SELECT bedarf, CASE WHEN mw > 0 AND mw <= 1 THEN 'gering' WHEN mw > 1 AND mw <= 2 THEN 'mittel'
  WHEN mw > 2 AND mw <= 3 THEN 'hoch' END AS bedarf_label,
  CASE WHEN r BETWEEN 0 AND 1 THEN 'konstant' WHEN r <= 3 THEN 'variierend' END AS sd_label FROM s)
SELECT *, {NEED_SENTENCE} AS erklaerung FROM b
""")
def banded_label(spark, sf):
    return a.need_bands(item_statistics(spark, sf)).select("bedarf", "bedarf_label", "sd_label", "erklaerung")


@query("SELECT p_brand, count(*) FILTER (1 + p_size % 6 >= 4) / count(*) AS share FROM part GROUP BY 1")
def share_ge(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(
        a.share_at_least(1 + F.col("p_size") % 6, 4).alias("share")
    )


@query("""
WITH v AS (SELECT nullif(p_size % 6, 0) AS value FROM part)
SELECT value, count(*) AS n, count(*) / (SELECT count(value) FROM v) AS percent FROM v WHERE value IS NOT NULL GROUP BY 1
""")
def frequency_of_valid(spark, sf):
    parts = table(spark, sf, "part").withColumn("value", F.nullif(F.col("p_size") % 6, F.lit(0)))
    return a.frequency_table(parts, "value")


@query("""
SELECT word, count(*) AS freq FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word HAVING count(*) > 4
""")
def word_frequency(spark, sf):
    words = reshape.multiselect_long(table(spark, sf, "documents"), "text", ["doc_id"], "word")
    return a.word_frequency(words, "word")


@query("SELECT lang, count(DISTINCT source) AS n_sources FROM documents GROUP BY lang")
def answerers(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count_distinct("source").alias("n_sources"))


@query("SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders")
def add_count(spark, sf):
    return a.add_count(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("""
SELECT *, n / sum(n) OVER (PARTITION BY segment) AS share
FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL)
""")
def add_count_share(spark, sf):
    who = table(spark, sf, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return a.share_of_group(a.counts(who, ["segment", "c_nationkey"]), "segment")


@query(f"""
SELECT r_name, c_mktsegment, CASE WHEN bool_and(c_acctbal < 9900) THEN count(*) END AS total
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def matrix_totals(spark, sf):
    who = customers(spark, sf).withColumn("n", F.when(F.col("c_acctbal") < 9900, 1))
    return a.matrix_totals(who, ["r_name", "c_mktsegment"])


@query("""
SELECT c_mktsegment, 1 + c_custkey % 6 AS value, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment) AS percent FROM customer GROUP BY 1, 2
""")
def conditional_distribution(spark, sf):
    who = table(spark, sf, "customer").withColumn("value", 1 + F.col("c_custkey") % 6)
    return a.distribution_within(who, ["c_mktsegment"], "value")


@query("""
WITH c AS (SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY year) AS share FROM c)
SELECT *, (SELECT max(share) FROM s WHERE year IN (1999, 2000)) AS y_limit FROM s WHERE year IN (1999, 2000)
""")
def shared_scale_max(spark, sf):
    from canvass.plans.network import largest_share

    o = orders_with_year(spark, sf).filter(F.col("year").isin(1999, 2000))
    s = a.share_of_group(a.counts(o, ["year", "o_orderpriority"]), "year")
    return s.withColumn("y_limit", largest_share(s, "share"))


@query("""
SELECT c_nationkey, c_mktsegment, c_custkey, c_name, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1
""")
def distinct_subset(spark, sf):
    return windows.dedup_first(
        table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"]
    )


# ------------------------------------------------------------------ windows


@query("""
WITH c AS (SELECT nullif(o_orderstatus, 'P') AS status, count(*) AS n FROM orders GROUP BY 1)
SELECT status, n, sum(n) OVER w::BIGINT AS csum, round_even(n * 100 / sum(n) OVER (), 1) AS perc,
  n / 2 + coalesce(sum(n) OVER (ORDER BY status NULLS LAST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS pos
FROM c WINDOW w AS (ORDER BY status NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""".replace("sum(n) OVER w::BIGINT", "(sum(n) OVER w)::BIGINT"))
def pie_positions(spark, sf):
    o = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return windows.stacked_positions(o, "status")


@query("""
WITH c AS (SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT *, rank() OVER (PARTITION BY year ORDER BY n)::INT AS min_rank,
  row_number() OVER (PARTITION BY year ORDER BY n, o_orderpriority)::INT AS stack_order FROM c
""")
def min_rank_level(spark, sf):
    n = a.counts(orders_with_year(spark, sf), ["year", "o_orderpriority"])
    return windows.stack_order(n, "year", "o_orderpriority", "n")


@query("""
SELECT p_type, count(*) AS total, row_number() OVER (ORDER BY count(*) DESC, p_type)::INT AS rank FROM part GROUP BY 1
""")
def levels_by_total(spark, sf):
    return windows.rank_levels(a.counts(table(spark, sf, "part"), "p_type"), "p_type", "n")


FIRST_ORDER = """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""


@query(FIRST_ORDER)
def dedup_first(spark, sf):
    return windows.dedup_first(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(f"SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM ({FIRST_ORDER}))")
def dedup_cascade(spark, sf):
    first = dedup_first(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.keep_ids(table(spark, sf, "lineitem"), first, "l_orderkey")


@query("""
WITH t AS (SELECT *, CASE WHEN role = 'user' AND length(text) % 3 = 0 THEN 1
  WHEN role = 'assistant' AND length(text) % 2 = 0 THEN 0 END AS mark FROM conversations),
s AS (SELECT *, last_value(mark IGNORE NULLS) OVER w AS state,
  last_value(CASE WHEN mark IS NOT NULL THEN turn END IGNORE NULLS) OVER w AS block FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, role, text, block FROM s WHERE mark IS NULL AND state = 1
""")
def matrix_block(spark, sf):
    size = F.length("text")
    return windows.marker_blocks(
        table(spark, sf, "conversations"), ["conv_id"], "turn",
        (F.col("role") == "user") & (size % 3 == 0), (F.col("role") == "assistant") & (size % 2 == 0),
        F.col("turn"), chunk=2,
    )


# --------------------------------------------------------- cleaning, scalars


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate AS "end", year(o_orderdate)::INT AS year
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < make_date(year(o_orderdate) + 1, 1, 1)
""")
def deadline_filter(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        orders_with_year(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return clean.before_deadline(
        lines.select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("end"), "year"), "year"
    )


@query("""
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax
FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0
""")
def all_null_row_drop(spark, sf):
    return clean.drop_empty_rows(
        measures_with_gaps(spark, sf).drop("l_quantity"), ["l_orderkey", "l_linenumber"]
    )


ANSWER = """CASE p_size % 5 WHEN 0 THEN p_size || '.7' WHEN 1 THEN p_size || 'x' WHEN 2 THEN ' ' || p_size || ' '
WHEN 3 THEN '' ELSE p_size || 'e1' END"""


@query(f"""
SELECT p_partkey, trunc(TRY_CAST(trim(a) AS DOUBLE))::INT AS as_int, TRY_CAST(trim(a) AS DOUBLE) AS as_double
FROM (SELECT p_partkey, {ANSWER} AS a FROM part)
""")
def safe_casts(spark, sf):
    size = F.col("p_size").cast("string")
    answer = (
        F.when(F.col("p_size") % 5 == 0, F.concat(size, F.lit(".7")))
        .when(F.col("p_size") % 5 == 1, F.concat(size, F.lit("x")))
        .when(F.col("p_size") % 5 == 2, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(F.col("p_size") % 5 == 3, F.lit(""))
        .otherwise(F.concat(size, F.lit("e1")))
    )
    parts = table(spark, sf, "part").select("p_partkey", answer.alias("answer"))
    return parts.select("p_partkey", m.to_int("answer").alias("as_int"), m.to_double("answer").alias("as_double"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 40 THEN l_quantity END AS hours,
  CASE WHEN l_quantity <= 30 THEN l_quantity END AS age FROM lineitem
""")
def outlier_to_null(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", m.keep_below("l_quantity", 40).alias("hours"),
        m.drop_above("l_quantity", 30).alias("age"),
    )


@query("""
SELECT c_custkey, trim(regexp_replace(c_name, '(?i)customer#|CUSTOMER #', '', 'g')) AS cleaned,
  replace(c_name, '000', '_') AS with_underscore, nullif(c_mktsegment, 'BUILDING') AS segment,
  coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment_text, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building Site'
  WHEN 'FURNITURE' THEN 'Furniture' WHEN 'AUTOMOBILE' THEN 'Automobile' WHEN 'HOUSEHOLD' THEN 'Household'
  WHEN 'MACHINERY' THEN 'Machinery' END AS spoken FROM customer
""")
def text_normalize(spark, sf):
    code = F.when(F.col("c_mktsegment") == "BUILDING", "building_site").otherwise(F.lower("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        t.without_words("c_name", ["customer#", "customer #"]).alias("cleaned"),
        t.plain_code(F.regexp_replace("c_name", "000", "___")).alias("with_underscore"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        m.null_to_empty(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("segment_text"),
        t.spoken_code(code).alias("spoken"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%A') AS day FROM orders
""")
def weekday_from_path(spark, sf):
    path = F.concat(F.lit("block_activities/"), F.lower(F.date_format("o_orderdate", "EEEE")), F.lit("_Stunden"))
    return table(spark, sf, "orders").select("o_orderkey", t.weekday_name(path).alias("day"))


@query("SELECT coalesce(nullif(o_orderstatus, 'P'), 'keine Angabe') AS status, count(*) AS n FROM orders GROUP BY 1")
def na_category(spark, sf):
    o = table(spark, sf, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return a.counts(clean.fill_no_answer(o, ["status"]), "status")


@query("SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus IN ('F')")
def na_category_drop(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", m.NO_ANSWER)
        .when(F.col("o_orderstatus") == "F", "F").alias("status"),
    )
    return clean.drop_no_answer(o, "status")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_mktsegment WHEN c_acctbal < 0 THEN 'X' ELSE 'eigen' || c_nationkey END
  AS region FROM customer
""")
def conditional_fill(spark, sf):
    who = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "name").alias("og_name"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).when(F.col("c_acctbal") < 0, "X").alias("og_region"),
        F.concat(F.lit("eigen"), F.col("c_nationkey")).alias("own"),
    )
    return who.select("c_custkey", clean.fill_region("og_name", "og_region", "own").alias("region"))


@query("""
SELECT year(o_orderdate)::INT AS year, count(*) FILTER (o_orderstatus = 'F') AS anzahl_ma_leitung,
  count(*) FILTER (o_orderstatus <> 'F') AS anzahl_tn, count(*) AS anzahl_insg FROM orders GROUP BY 1
""")
def boolean_proxy_counts(spark, sf):
    o = orders_with_year(spark, sf).withColumn(
        "antwort", F.when(F.col("o_orderstatus") == "F", "Ja").when(F.col("o_orderstatus") == "O", "Nein")
    )
    return a.headcounts_from_people(o, ["year"], "antwort")


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Bau' WHEN 'FURNITURE' THEN 'Möbel' ELSE c_mktsegment END AS title,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Bau' WHEN 'FURNITURE' THEN 'Möbel' ELSE c_name END AS sort_title FROM customer
""")
def title_lookup(spark, sf):
    titles = {"BUILDING": "Bau", "FURNITURE": "Möbel"}
    return table(spark, sf, "customer").select(
        "c_custkey", t.titled("c_mktsegment", titles).alias("title"),
        t.titled("c_mktsegment", titles, "c_name").alias("sort_title"),
    )


@query(f"""
WITH o AS (SELECT o_orderkey FROM {PLACED} WHERE r_name = 'EUROPE')
SELECT 'lineitem' AS tab, count(*) AS n, sum(l_quantity) AS amount FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)
UNION ALL SELECT 'data', count(*), NULL FROM o
UNION ALL SELECT 'agg', count(*), NULL FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'
""")
def region_slice(spark, sf):
    data = placed_orders(spark, sf).withColumnsRenamed({"o_orderkey": "l_orderkey", "r_name": "region_grouped"})
    part = clean.slice_region(
        data,
        {"lineitem": table(spark, sf, "lineitem"), "agg": nations(spark, sf).withColumnRenamed("r_name", "region_grouped")},
        "EUROPE", ["l_orderkey"],
    )
    n = F.count(F.lit(1)).alias("n")
    return sets.union_all([
        part["lineitem"].agg(F.lit("lineitem").alias("tab"), n, F.sum("l_quantity").alias("amount")),
        part["data"].agg(F.lit("data").alias("tab"), n),
        part["agg"].agg(F.lit("agg").alias("tab"), n),
    ])


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'insgesamt' ELSE lower(c_mktsegment) END AS option FROM customer
""")
def code_from_expression(spark, sf):
    rule = F.when(
        F.col("c_acctbal") >= 0, F.concat(F.lit("selected(${F9}, '"), F.lower("c_mktsegment"), F.lit("')"))
    )
    forms_like = table(spark, sf, "customer").select("c_custkey", rule.alias("relevant"))
    return c.option_codes(forms_like).select("c_custkey", "option")


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'stimmt nicht (6)' WHEN p_size % 3 = 1 THEN 'stimmt (1)' ELSE 'teils (3)' END
  AS swapped, replace(printf('%,d', (p_partkey * 1000)::BIGINT), ',', '.') AS dotted,
  replace(printf('%.1f', round_even(p_size / 50 * 100, 1)), '.', ',') || '%' AS percent
FROM part
""")
def display_formats(spark, sf):
    label = F.when(F.col("p_size") % 3 == 0, "stimmt nicht (1)").when(F.col("p_size") % 3 == 1, "stimmt (6)").otherwise("teils (3)")
    return table(spark, sf, "part").select(
        "p_partkey", t.swap_scale_ends(label).alias("swapped"),
        t.dotted_number(F.col("p_partkey") * 1000).alias("dotted"),
        t.comma_percent(F.col("p_size") / 50).alias("percent"),
    )


# ------------------------------------------------------------ form metadata


def part_form(spark, sf):
    """Parts read as form rows: p_name is the question name, p_type its type."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.col("p_type").alias("type"),
        F.col("p_brand").alias("label"), F.col("p_name").alias("col_name"),
        F.lit(None).cast("string").alias("kuid"), F.lit(None).cast("string").alias("autoname"),
        F.col("p_type").alias("list_name"), F.lit(None).cast("string").alias("matrix_list"),
        F.lit(None).cast("string").alias("relevant"),
    )


@query("SELECT p_partkey AS ord, p_name AS name, p_type AS type FROM part WHERE regexp_matches(p_name, '^r.+?t$') AND p_type = 'PROMO'")
def question_find(spark, sf):
    return c.find_questions(part_form(spark, sf), "name", "^r.+?t$", "PROMO").select("ord", "name", "type")


@query("SELECT r_regionkey AS ord, r_name AS name FROM region WHERE regexp_matches(r_name, '^EU')")
def question_find_one(spark, sf):
    rows = table(spark, sf, "region").select(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("name"))
    return c.find_question(rows, "name", "^EU")


@query("""
SELECT 'rot' AS q_key, p_partkey AS ord, p_name AS name FROM part WHERE regexp_matches(p_name, 'red')
UNION ALL SELECT 'klein', p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'small') AND p_type = 'LARGE'
  AND NOT regexp_matches(p_name, 'ring') AND regexp_matches(p_brand, '1')
""")
def catalog_build(spark, sf):
    specs = [
        c.Question("rot", "name", "red", many=True),
        c.Question("klein", "name", "small", "LARGE", True, contains=("label", "1"), lacks=("name", "ring")),
    ]
    return c.build_catalog(part_form(spark, sf), specs).select("q_key", "ord", "name")


@query("""
SELECT event_id, k, k * 2 AS double_k, '{"k":' || k || '}' AS again, event_type AS label
FROM (SELECT event_id, event_type, (props::JSON ->> 'k')::BIGINT AS k FROM events)
""")
def json_extract(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("ord"), F.from_json("props", "k bigint").getField("k").alias("k"), F.array("event_type").alias("label")
    )
    again = forms.question_json(e, "again", ["k"])
    parsed = again.withColumn("k", F.from_json("again", "k bigint").getField("k"))
    return parsed.select(
        F.col("ord").alias("event_id"), "k", (F.col("k") * 2).alias("double_k"), "again",
        forms.flat_label("label").alias("label"),
    )


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem")
def project_by_name_rule(spark, sf):
    lines = clean.drop_system_columns(
        table(spark, sf, "lineitem"), prefixes=("l_line", "l_ship"), names=("l_extendedprice", "l_discount", "l_tax")
    )
    return clean.pick(lines, ["l_quantity", "l_returnflag"], suffix="key")


@query("""
SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS frage_1, NULL::VARCHAR AS frage_2 FROM orders
""")
def add_missing_columns(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return clean.add_missing_columns(o, ["o_orderstatus", "frage_1", "frage_2"])


def priority_choices(spark, sf):
    levels = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("p")).distinct()
    return levels.select(
        F.substring("p", 1, 1).alias("name"), F.col("p").alias("label"), F.lit("prio").alias("list_name"),
        F.substring("p", 1, 1).cast("int").alias("ord"),
    )


@query("""
SELECT DISTINCT o_orderpriority[1:1] AS name, o_orderpriority AS label,
  CASE o_orderpriority[1:1] WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 WHEN '4' THEN 3 END AS rank FROM orders
""")
def choice_rank(spark, sf):
    return c.ranked_choices(priority_choices(spark, sf), "prio", {"1": 0, "2": 1, "3": 2, "4": 3, "5": None})


@query("""
SELECT o_orderkey, CASE code WHEN '1' THEN 'DRINGEND' WHEN '9' THEN 'Insgesamt' ELSE o_orderpriority END AS code
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN '9' ELSE o_orderpriority[1:1] END AS code FROM orders)
""")
def mapping_patch_and_extend(spark, sf):
    mapping = c.mapping_of(priority_choices(spark, sf), "prio")
    mapping = c.patch_mapping(c.extend_mapping(mapping, "9", "Insgesamt"), "1", "DRINGEND")
    code = F.when(F.col("o_orderstatus") == "P", "9").otherwise(F.substring("o_orderpriority", 1, 1))
    o = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    return joins.recode(o, mapping, "code")


# --------------------------------------------------------- sets, editions


@query("""
SELECT c_custkey AS id, c_acctbal AS acctbal, c_mktsegment AS segment, NULL::VARCHAR AS name FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier
""")
def union_missing_cols(spark, sf):
    who = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")
    )
    by = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name")
    )
    return sets.union_all([who, by])


@query("""
SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) IN (1999, 2000) ORDER BY 1
""")
def level_union(spark, sf):
    o = orders_with_year(spark, sf)
    return sets.level_union([o.filter("year = 1999"), o.filter("year = 2000")], "o_custkey")


@query("""
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1999 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000
""")
def except_levels(spark, sf):
    o = orders_with_year(spark, sf)
    return sets.level_difference(o.filter("year = 1999"), o.filter("year = 2000"), "o_custkey")


@query(f"""
WITH c AS (SELECT r_name AS region_grouped, year(o_orderdate)::INT AS year, count(DISTINCT c_custkey) AS n FROM {PLACED}
  WHERE NOT (r_name = 'ASIA' AND year(o_orderdate) % 2 = 0) GROUP BY ALL),
t AS (SELECT region_grouped, row_number() OVER (ORDER BY sum(n) DESC, region_grouped)::INT AS rank FROM c GROUP BY 1),
y AS (SELECT DISTINCT year FROM c)
SELECT t.region_grouped, y.year, coalesce(c.n, 0)::BIGINT AS ortsgruppen, t.rank FROM t CROSS JOIN y
LEFT JOIN c ON c.region_grouped = t.region_grouped AND c.year = y.year
""")
def trend_complete(spark, sf):
    # gaps: one region is not surveyed in even years
    o = placed_orders(spark, sf).filter("NOT (r_name = 'ASIA' AND year % 2 = 0)")
    totals = o.select("year", F.col("r_name").alias("region_grouped"), F.col("c_custkey").alias("og_name"))
    return trends.groups_per_year_and_region(totals)


@query("""
WITH c AS (SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n FROM orders
  WHERE NOT (o_orderpriority = '1-URGENT' AND year(o_orderdate) % 2 = 0) GROUP BY 1, 2),
g AS (SELECT year, o_orderpriority, sum(n)::BIGINT AS n FROM (SELECT * FROM c UNION ALL
  SELECT y.year, p.o_orderpriority, 0 FROM (SELECT DISTINCT year FROM c) y, (SELECT DISTINCT o_orderpriority FROM c) p) GROUP BY 1, 2)
SELECT *, rank() OVER (PARTITION BY year ORDER BY n)::INT AS min_rank,
  row_number() OVER (PARTITION BY year ORDER BY n, o_orderpriority)::INT AS stack_order FROM g
""")
def year_chart(spark, sf):
    # gaps: one answer does not exist in even years
    o = orders_with_year(spark, sf).filter("NOT (o_orderpriority = '1-URGENT' AND year % 2 = 0)")
    n = a.counts(o, ["year", "o_orderpriority"])
    return windows.year_chart(n, "year", "n", "o_orderpriority")


@query("""
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer
ORDER BY segment NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey
""")
def sorted_nulls_last(spark, sf):
    who = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal"
    )
    return sets.sorted_nulls_last(who, ["segment", "c_acctbal", "c_custkey"], descending=["c_acctbal"])


@query("""
WITH y AS (SELECT max(year(o_orderdate)) AS cur FROM orders)
SELECT year(o_orderdate)::INT AS year, year(o_orderdate) = cur AS is_current, count(*) AS n FROM orders, y
WHERE year(o_orderdate) IN (cur, cur - 1) GROUP BY ALL
""")
def edition_resolve(spark, sf):
    o = orders_with_year(spark, sf)
    current, previous = editions.current_and_previous(editions.edition_years(o))
    wanted = o.filter(F.col("year").isin([y for y in (current, previous) if y is not None]))
    return a.counts(wanted.withColumn("is_current", F.col("year") == current), ["year", "is_current"])


@query("SELECT c_mktsegment FROM customer")
def delink(spark, sf):
    return privacy.delink(table(spark, sf, "customer"), "c_mktsegment", ["c_custkey"])


@query("""
SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::INT AS y FROM part
""")
def form_row_numbers(spark, sf):
    return windows.number_rows(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey", by=["p_brand"])


@query("""
SELECT p_brand AS q_key, count(*) AS n_questions, string_agg(p_name, chr(10) ORDER BY p_partkey) AS questions
FROM part WHERE p_brand IN ('Brand#11', 'Brand#25', 'Brand#33') GROUP BY 1
""")
def source_labels(spark, sf):
    questions = table(spark, sf, "part").select(
        F.col("p_brand").alias("q_key"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("label")
    )
    return c.source_labels(questions, ["Brand#11", "Brand#25", "Brand#33"])


# The closed list of brands of part.
NAMED_BRANDS = BRANDS[:25]


@query("""
SELECT p_brand AS q_key, count(*) AS n_questions, string_agg(p_name, chr(10) ORDER BY p_partkey) AS questions
FROM part GROUP BY 1
""")
def source_labels_whole(spark, sf):
    questions = table(spark, sf, "part").select(
        F.col("p_brand").alias("q_key"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("label")
    )
    return c.source_labels(questions, NAMED_BRANDS)


@query("""
SELECT p_partkey, '  ' || p_name || ' SEP ' || p_type AS label_short FROM part
""")
def scale_labels(spark, sf):
    text = F.concat(F.lit('Dein Eindruck: von "'), "p_name", F.lit('" bis "'), "p_type", F.lit('"'))
    parts = table(spark, sf, "part").select("p_partkey", text.alias("label"))
    return parts.select("p_partkey", t.scale_label("label", "Dein Eindruck").alias("label_short"))


@query("""
SELECT CASE grouping(year, status, priority) WHEN 0 THEN 'cell' WHEN 1 THEN 'status' WHEN 3 THEN 'year' ELSE 'all' END AS level,
  year, status, priority, count(DISTINCT customer) + max((customer IS NULL)::INT) AS respondents,
  CASE WHEN count(*) = count(price) THEN round(sum(price), 2) END AS strict_price, round(coalesce(sum(price), 0), 2) AS known_price
FROM (SELECT year(o_orderdate)::INT AS year, o_orderstatus AS status, o_orderpriority AS priority,
  CASE WHEN o_custkey % 11 > 0 THEN o_custkey END AS customer, CASE WHEN o_orderkey % 5003 > 0 THEN o_totalprice END AS price FROM orders)
GROUP BY GROUPING SETS ((), (year), (year, status), (year, status, priority))
""")
def distinct_levels(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_custkey") % 11 > 0, F.col("o_custkey")).alias("customer"),
        F.when(F.col("o_orderkey") % 5003 > 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
    )
    cells = partials.states(partials.numbered(rows, "customer"), ["year", "status", "priority"], ["price"])
    levels = {"all": [], "year": ["year"], "status": ["year", "status"], "cell": ["year", "status", "priority"]}
    return partials.merged(cells, levels).select(
        "level", "year", "status", "priority", partials.entities().alias("respondents"),
        partials.strict_total("price").cast("double").alias("strict_price"), partials.known_total("price").cast("double").alias("known_price"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS l_quantity, row_number() OVER (ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS row_number
FROM lineitem
""")
def row_numbers_whole(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"))
    return ranges.row_numbers(lines, ["l_quantity", "l_orderkey", "l_linenumber"], descending=["l_quantity"])


@query("""
SELECT l_orderkey, l_linenumber, q, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_quantity::INT END AS q FROM lineitem)
WINDOW w AS (ORDER BY q DESC)
""")
def ranks_whole(spark, sf):
    """A third of all rows share one value."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_quantity").cast("int")).alias("q")
    )
    return ranges.ranks(lines, ["q"], descending=["q"])


@query("""
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS mode, count(l_extendedprice) AS n,
  round(quantile_cont(l_extendedprice::DOUBLE, 0.25), 6) AS q25, round(median(l_extendedprice::DOUBLE), 6) AS q50,
  round(quantile_cont(l_extendedprice::DOUBLE, 0.9), 6) AS q90 FROM lineitem GROUP BY 1
""")
def quantiles_open(spark, sf):
    """Exact quantiles of prices, one group holding a third of all rows."""
    mode = F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_returnflag")).alias("mode")
    lines = table(spark, sf, "lineitem").select(mode, "l_extendedprice")
    told = ranges.quantiles(lines, "l_extendedprice", [0.25, 0.5, 0.9], ["mode"])
    return told.select("mode", "n", *[F.round(F.col("quantiles")[i], 6).alias(c) for i, c in enumerate(["q25", "q50", "q90"])])


@query("""
SELECT page_id, url, name, label FROM pages JOIN (
  SELECT 'example\\.(com|org|net)/[a-z]+/' || s_suppkey || '($|[?#])' AS name, s_name AS label FROM supplier
  UNION ALL SELECT '^https?://m\\.|/' || s_suppkey || '\\?page=', 'mobile' FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL VALUES ('/(de|fr)/', 'short'), ('', 'all'), (NULL, 'none')
) ON regexp_matches(url, name)
""")
def regex_join_table(spark, sf):
    """Urls against as many patterns as there are suppliers."""
    who = table(spark, sf, "supplier")
    number = F.col("s_suppkey").cast("string")
    found = who.select(F.concat(F.lit(r"example\.(com|org|net)/[a-z]+/"), number, F.lit("($|[?#])")).alias("name"), F.col("s_name").alias("label"))
    mobile = who.filter("s_suppkey % 10 = 0").select(F.concat(F.lit(r"^https?://m\.|/"), number, F.lit(r"\?page=")), F.lit("mobile"))
    few = local_table(spark, [("/(de|fr)/", "short"), ("", "all"), (None, "none")], "name string, label string")
    return joins.regex_join(table(spark, sf, "pages").select("page_id", "url"), found.union(mobile).union(few), "url")


TYPED = """(SELECT p_name || ' ' || p_type AS known, p_partkey % 10 + 1 AS pos FROM part)"""


@query(f"""
WITH typed AS (SELECT CASE pos % 3 WHEN 0 THEN left(known, pos - 1) || substr(known, pos + 1)
    WHEN 1 THEN left(known, pos - 1) || 'xyz' || substr(known, pos) ELSE left(known, pos - 1) || 'q' || substr(known, pos + 1) END AS typed
  FROM {TYPED} WHERE pos > 2),
known AS (SELECT DISTINCT known FROM {TYPED}),
un AS (SELECT typed, count(*) AS count FROM typed WHERE typed NOT IN (SELECT known FROM known) GROUP BY 1),
near AS (SELECT typed, known AS proposal, levenshtein(typed, known) AS distance FROM un JOIN known ON levenshtein(typed, known) <= 2)
SELECT un.typed, count, proposal, distance, CASE WHEN proposal IS NOT NULL THEN row_number() OVER (PARTITION BY un.typed ORDER BY distance, proposal) END AS rank
FROM un LEFT JOIN near ON un.typed = near.typed
""")
def name_proposals(spark, sf):
    """Names typed with one wrong, one lost or three added letters."""
    rows = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("known"), (F.col("p_partkey") % 10 + 1).cast("int").alias("at"))
    way = F.col("at") % 3
    ahead = F.substring("known", F.lit(1), F.col("at") - 1)
    wrong = F.concat(
        ahead, F.when(way == 0, "").when(way == 1, "xyz").otherwise("q"),
        F.substring("known", F.col("at") + F.when(way == 1, 0).otherwise(1), F.length("known")),
    )
    typed = rows.filter("at > 2").select(wrong.alias("typed"))
    known = rows.select("known").distinct()
    return propose(joins.unmapped(typed, known, "typed", "known"), known, "typed", "known")


@query("""
WITH c AS (SELECT n_regionkey AS g, n_name AS r, c_mktsegment AS c, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 3 > 0 OR c_nationkey % 2 > 0 GROUP BY ALL),
cells AS (SELECT g, r, c, sum(n) AS n, grouping(c) = 1 AS rt, grouping(r) = 1 AS ct FROM c GROUP BY GROUPING SETS ((g, r, c), (g, r), (g, c), (g))),
small AS (SELECT * FROM cells WHERE n < 9),
pairs AS (
  SELECT g, r, c, (SELECT (list(x.c ORDER BY x.n, x.c))[1] FROM c x WHERE x.g = s.g AND x.r = s.r AND x.c <> s.c) AS c2,
    (SELECT (list(x.r ORDER BY x.n, x.r))[1] FROM c x WHERE x.g = s.g AND x.c = s.c AND x.r <> s.r) AS r2 FROM small s WHERE NOT rt AND NOT ct
  UNION ALL
  SELECT g, r, c, c2, (SELECT (list(x.r ORDER BY x.n, x.r))[1] FROM c x WHERE x.g = t.g AND x.c = c2 AND x.r <> t.r) FROM (
    SELECT *, (SELECT (list(x.c ORDER BY x.n, x.c))[1] FROM c x WHERE x.g = s.g AND x.r = s.r) AS c2 FROM small s WHERE rt AND NOT ct) t
  UNION ALL
  SELECT g, r, c, (SELECT (list(x.c ORDER BY x.n, x.c))[1] FROM c x WHERE x.g = t.g AND x.r = r2 AND x.c <> t.c), r2 FROM (
    SELECT *, (SELECT (list(x.r ORDER BY x.n, x.r))[1] FROM c x WHERE x.g = s.g AND x.c = s.c) AS r2 FROM small s WHERE ct AND NOT rt) t
  UNION ALL
  SELECT g, r, c, (SELECT (list(x.c ORDER BY x.n, x.r, x.c))[1] FROM c x WHERE x.g = s.g),
    (SELECT (list(x.r ORDER BY x.n, x.r, x.c))[1] FROM c x WHERE x.g = s.g) FROM small s WHERE rt AND ct),
taken AS (SELECT DISTINCT * FROM (SELECT g, r, c2 AS c FROM pairs UNION ALL SELECT g, r2, c FROM pairs UNION ALL SELECT g, r2, c2 FROM pairs))
SELECT coalesce(k.g, t.g) AS n_regionkey, coalesce(k.r, t.r) AS n_name, coalesce(k.c, t.c) AS c_mktsegment,
  coalesce(k.c, t.c) IS NULL AS row_total, coalesce(k.r, t.r) IS NULL AS column_total,
  CASE WHEN k.n >= 9 AND t.g IS NULL THEN k.n::BIGINT END AS released,
  CASE WHEN k.n < 9 THEN 'small' WHEN t.g IS NOT NULL THEN 'companion' END AS withheld
FROM cells k FULL JOIN taken t ON k.g = t.g AND k.r IS NOT DISTINCT FROM t.r AND k.c IS NOT DISTINCT FROM t.c
""")
def protected_totals(spark, sf):
    """Customers of each nation and segment, one table with totals for each region."""
    who = customers(spark, sf).filter((F.col("c_custkey") % 3 > 0) | (F.col("c_nationkey") % 2 > 0))
    counted = who.groupBy("n_regionkey", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return privacy.protected_totals(counted, ["n_regionkey"], "n_name", "c_mktsegment", k=9)
