"""Cleaning tables and result tables of the survey, over whole tables.

The SQL starts from the same raw answers and computes every table on its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.operators import catalog as c
from canvass.operators.clean import before_deadline
from canvass.operators.sets import union_all
from canvass.operators.windows import year_chart
from canvass.plans import combine, groups, network, people, regions, topics, trends
from canvass.plans.editions import Plans
from canvass.operators.partials import entities, known_total, merged, numbered, states, strict_total
from canvass.sources import editions, ledger

from . import forms as f
from .operators import NEED_SENTENCE
from .registry import query

# ------------------------------------------------------------- Spark tables


class Survey:
    """Cleaning plans over the submissions of one input folder; nothing runs before a result is asked for."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf
        self.regions, self.spelling = f.region_map(spark), f.spelling_map(spark, sf)

    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        return groups.clean_groups(f.group_submissions(self.spark, self.sf), f.form(self.spark, "og"), self.regions)

    @cached_property
    def people(self) -> Mapping[str, DataFrame]:
        return people.clean_people(
            f.person_submissions(self.spark, self.sf), f.form(self.spark, "tn"), self.spelling, self.regions, f.BRAND_WORDS
        )

    @cached_property
    def first(self) -> Mapping[str, DataFrame]:
        named = self.raw.replaced(
            "og.data", lambda: groups.harmonize_groups(self.raw["og.data"], self.spelling, self.regions)
        )
        return groups.first_submissions(named)

    @cached_property
    def years(self) -> DataFrame:
        """Editions with group submissions in time; only their years are read."""
        return editions.editions(before_deadline(f.group_submissions(self.spark, self.sf).select("year", "end"), "year"))

    @cached_property
    def totals(self) -> DataFrame:
        return combine.combined_totals(self.first["og.data"], self.people["tn.data"])

    @cached_property
    def plans(self) -> Plans:
        return Plans(self.raw, self.people, self.regions, self.spelling)


@lru_cache(maxsize=8)
def survey(spark: SparkSession, sf: str) -> Survey:
    """One set of plans for each session and folder; plans hold no data."""
    return Survey(spark, sf)


class Tables:
    """Tables by name."""

    def __init__(self, plans: Plans) -> None:
        self.plans = plans

    def __getitem__(self, name: str) -> DataFrame:
        return self.plans.table("og.agg.total_tn_by_og" if name == "totals" else name)


def tables(spark: SparkSession, sf: str) -> Tables:
    return Tables(survey(spark, sf).plans)


def choice_labels(spark, list_name: str, code: str, label: str) -> DataFrame:
    return local_table(spark, f.CHOICES[list_name], f"{code} string, {label} string")


# ---------------------------------------------------------------- SQL pieces


def lab(column: str, list_name: str, **patch: str) -> str:
    pairs = dict(f.CHOICES[list_name]) | patch
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"


def dbl(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


def num(column: str) -> str:
    return f"CAST(trunc({dbl(column)}) AS INT)"


def p(path: str) -> str:
    return f'"{path}"'


def open_ticks(name: str, source: str, path: str, text: str, other: str, list_name: str, option: str, out: str,
               fix: str = "o") -> str:
    ids = "year, tn_id"
    return f"""{name} AS (SELECT {ids}, {lab(fix, list_name)} AS {option}, CASE WHEN o = '{other}' THEN t END AS {out}
  FROM (SELECT {ids}, unnest(string_split({p(path)}, ' ')) AS o, {p(text)} AS t FROM {source} WHERE {p(path)} IS NOT NULL))"""


def closed_ticks(name: str, path: str, list_name: str, option: str) -> str:
    return f"""{name} AS (SELECT year, tn_id, {lab('o', list_name)} AS {option}
  FROM (SELECT year, tn_id, unnest(string_split({p(path)}, ' ')) AS o FROM tr WHERE {p(path)} IS NOT NULL))"""


def union_columns(rows: list[tuple[str, str]], source: str, ids: str, value: str) -> str:
    """rows: (path, labels as SQL select list)."""
    return " UNION ALL ".join(
        f"SELECT {ids}, {labels}, {p(path)} AS {value} FROM {source} WHERE {p(path)} IS NOT NULL" for path, labels in rows
    )


TRAITS = [r for r in f.PERSON_FORM if r[4] and r[4].startswith(f.P2)]
STATEMENTS = ["kreativ", "lernen", "glaube_spiritualitaet", "transfer"]
NEEDS = [("technik", "Technik"), ("geld", "Geld"), ("werbung", "Werbung")]
SUCCESS = [("insgesamt", "Insgesamt"), ("flyer", "Flyer verteilen"), ("social_media", "Soziale Medien"),
           ("sonstige", "Sonstige Maßnahmen")]
WHO = [("mitarbeitende", "Mitarbeitende (inkl. Leitung)"), ("teilnehmende", "Teilnehmende")]


def matrix_sql(block: str, list_name: str, option: str) -> str:
    rows = [
        (f"{f.D}{block}_{code}_{who}", f"'{person}' AS person_type, '{label}' AS {option}")
        for code, label in f.CHOICES[list_name] for who, person in WHO
    ]
    body = union_columns(rows, "gr", "year, og_id", "v")
    return f"SELECT year, og_id, person_type, {option}, {num('v')} AS n FROM ({body})"


def first_only(cte: str) -> str:
    return f"SELECT * FROM {cte} WHERE (year, og_id) IN (SELECT (year, og_id) FROM gd)"


SPELL_SQL = f"""SELECT raw, 'Gruppe ' || g AS og_name, {f.GROUP_REGION} AS og_region FROM
  (SELECT DISTINCT c_custkey // 14 AS g FROM customer) JOIN (VALUES ('Gruppe '), ('gruppe ')) AS v(w) ON true,
  LATERAL (SELECT w || g AS raw)"""

HOURS = f"""CASE d WHEN 'Montag' THEN {num(p(f.A + 'Montag_Stunden'))}
  WHEN 'Dienstag' THEN {num(p(f.A + 'dienstag_stunden'))} END"""

CTES = f"""WITH
reg(og_region, region_grouped, slug) AS (VALUES {', '.join(str(r) for r in f.REGIONS)}),
sp AS ({SPELL_SQL}),
tr AS (SELECT * FROM (SELECT o_orderkey AS tn_id, {f.PERSON_BASE['year']} AS year, {f.PERSON_BASE['end']} AS "end",
  {', '.join(f'{e} AS {p(path)}' for path, e in f.person_answers().items())} FROM orders)
  WHERE "end" < make_date(year + 1, 1, 1)),
gr AS (SELECT * FROM (SELECT c_custkey AS og_id, {f.GROUP_BASE['year']} AS year, {f.GROUP_BASE['end']} AS "end",
  {', '.join(f'{e} AS {p(path)}' for path, e in f.group_answers().items())} FROM customer)
  WHERE "end" < make_date(year + 1, 1, 1) AND coalesce({', '.join(p(x) for x in f.group_answers())}) IS NOT NULL),
gd0 AS (SELECT gr.year, og_id, {num(p(f.A + 'F2_Anzahl_Auftritte'))} AS auftritte,
  {lab(p(f.A + 'F4_Hauptamt'), 'staff')} AS hat_hauptamt, {dbl(p(f.A + 'Hauptamt_Wochenstunden'))} AS hauptamt_stunden,
  {num(p('block_aktive/Mitarbeitende_inkl_Leitung'))} AS anzahl_ma_leitung, {num(p('block_aktive/Teilnehmende'))} AS anzahl_tn,
  {lab(p(f.B + 'tngewinnung_probleme'), 'problems')} AS hat_probleme_tn_gewinnung,
  {p('weitereUnterstuetzung')} AS unterstuetzungsbedarfe_weitere, {lab(p(f.W + 'region'), 'regions')} AS og_region,
  nullif({p(f.W + 'ortsgruppe_name')}, '') AS og_name_orig FROM gr),
gd AS (SELECT x.*, region_grouped, anzahl_tn + anzahl_ma_leitung AS anzahl_insg FROM (
  SELECT gd0.* EXCLUDE (og_region), gd0.og_region AS og_region_orig, sp.og_name, sp.og_region
  FROM gd0 JOIN sp ON og_name_orig = raw
  QUALIFY row_number() OVER (PARTITION BY gd0.year, sp.og_name ORDER BY og_id) = 1) x
  LEFT JOIN reg ON x.og_region = reg.og_region),
days0 AS (SELECT year, og_id, d AS wochentag, {HOURS} AS stunden FROM (SELECT *, upper(c[1:1]) || c[2:] AS d FROM
  (SELECT *, unnest(string_split({p(f.A + 'F1_Wochentage')}, ' ')) AS c FROM gr WHERE {p(f.A + 'F1_Wochentage')} IS NOT NULL))),
gw0 AS (SELECT year, og_id, {lab('o', 'workshops')} AS angebote_vor_ort FROM
  (SELECT year, og_id, unnest(string_split({p(f.A + 'angebote_vor_ort')}, ' ')) AS o FROM gr
   WHERE {p(f.A + 'angebote_vor_ort')} IS NOT NULL)),
gen0 AS ({matrix_sql('block_gender', 'm_gender', 'gender')}),
age0 AS ({matrix_sql('group_jahre', 'm_age', 'alter')}),
mea0 AS ({' UNION ALL '.join(
    f"SELECT year, og_id, {num(p(f.E + code))} AS erfolg, '{label}' AS massnahme, "
    + (f"CASE WHEN list_contains(string_split({p(f.B + 'tngewinnung_massnahmen')}, ' '), 'sonstige') THEN {p(f.B + 'tngewinnung_massnahmen_sonst')} END"
       if code == 'sonstige' else "NULL")
    + f" AS massnahme_sonst FROM gr WHERE {p(f.E + code)} IS NOT NULL" for code, label in SUCCESS)}),
need0 AS (SELECT year, og_id, bedarf, {lab('v', 'need')} AS bedarf_value FROM
  ({union_columns([(f.S + code, f"'{label}' AS bedarf") for code, label in NEEDS], 'gr', 'year, og_id', 'v')})),
days AS ({first_only('days0')}), gw AS ({first_only('gw0')}), gen AS ({first_only('gen0')}),
age AS ({first_only('age0')}), mea AS ({first_only('mea0')}), need AS ({first_only('need0')}),
tp AS (SELECT year, tn_id, CASE WHEN h < 40 THEN h END AS stunden_pro_woche, og_name_orig, wahrsch_empfehlung,
  CASE WHEN a <= 99 THEN a END AS alter, og_region_orig, teilnahme_og_uebergreifend, teilnahme_dtlweit, verantwortung_janein,
  info_komplett, info_wege_aenderung, og_name_cleaned, y.og_name,
  CASE WHEN y.og_name IS NULL AND y.sp_region IS NULL THEN og_region_orig ELSE y.sp_region END AS og_region FROM (
  SELECT x.*, sp.og_name, sp.og_region AS sp_region FROM (SELECT year, tn_id, {dbl(p(f.P4 + 'zeit_pro_woche'))} AS h,
    nullif({p(f.P4 + 'ortsgruppe_name')}, '') AS og_name_orig, {dbl(p(f.P6 + 'weiterempfehlung'))} AS wahrsch_empfehlung,
    {num(p('block_demografie/jahre'))} AS a, {lab(p(f.P4 + 'ortsgruppe_region'), 'regions', owl='Ostwestfalen-Lippe')} AS og_region_orig,
    {lab(p(f.P5 + 'veranst_region'), 'yesno')} AS teilnahme_og_uebergreifend, {lab(p(f.P5 + 'veranst_weit'), 'yesno')} AS teilnahme_dtlweit,
    {lab(p(f.P6 + 'verantwortung'), 'yesno')} AS verantwortung_janein, {lab(p(f.P6 + 'informationen_komplett'), 'complete')} AS info_komplett,
    {lab(p(f.P6 + 'info_aenderung'), 'change')} AS info_wege_aenderung,
    trim(regexp_replace(coalesce({p(f.P4 + 'ortsgruppe_name')}, ''), 'singkreis|sing kreis|sing-kreis', '', 'gi')) AS og_name_cleaned
    FROM tr) x LEFT JOIN sp ON og_name_cleaned = raw) y),
td AS (SELECT tp.* EXCLUDE (alter), region_grouped FROM tp LEFT JOIN reg ON tp.og_region = reg.og_region),
ages AS (SELECT year, og_name, CASE WHEN count(*) >= 3 THEN round_even(avg(alter), 0) END AS avg_alter, count(*) AS n
  FROM tp GROUP BY 1, 2),
words AS ({union_columns([(f.P1 + f'Wort_{i}', "'x' AS q") for i in (1, 2, 3)], 'tr', 'year, tn_id', 'wort')}),
traits AS ({union_columns([(r[4], f"'{r[1]}' AS eig, '{r[6]}' AS eig_label") for r in TRAITS], 'tr', 'year, tn_id', 'value')}),
stm AS ({' UNION ALL '.join(f"SELECT year, tn_id, '{n}' AS aussage, {p(f.P3 + n)} AS value FROM tr" for n in STATEMENTS)}),
stagg AS (SELECT year, aussage, count(value) AS total_non_na, avg(value::DOUBLE) AS average,
  count(*) FILTER (value::INT > 3) AS zustimmung, count(*) FILTER (value::INT > 3) / count(value) AS zustimmung_perc
  FROM stm GROUP BY 1, 2),
{open_ticks('access', 'tr', 'block_zugang/zugangsweg', 'block_zugang/zugangsweg_sonst', 'sonstiges', 'access', 'zugangsweg', 'zugangsweg_sonst')},
{open_ticks('tw', 'tr', f.P4 + 'angebote_vor_ort', f.P4 + 'andere_angebote_vor_ort', 'andere_workshops', 'workshops', 'angebot', 'angebot_sonst', "replace(o, '___', '_')")},
{open_ticks('reasons', 'tr', f.P5 + 'gruende_gegen', f.P5 + 'gruende_gegen_andere', 'andere_gr_nde', 'reasons', 'grund', 'andere_gruende')},
{open_ticks('help', 'tr', f.P6 + 'hilfe_fuer_verantwortung', f.P6 + 'hilfe_fuer_verantwortung_sonst', 'sonstiges', 'help', 'hilfsangebot', 'hilfsangebot_sonst')},
{open_ticks('contact', 'tr', 'block_demografie/kontakt', 'block_demografie/kontakt_sonst', 'ja_andere', 'contact', 'kontaktpunkt', 'kontakt_chrgl_sonst')},
{closed_ticks('now', f.P6 + 'informationswege_derzeit', 'channels', 'info_weg')},
{closed_ticks('wish', f.P6 + 'info_wunsch', 'channels', 'info_weg')},
est AS (SELECT year, coalesce(region_grouped, 'keine Angabe') AS region_grouped, og_region, coalesce(og_name, 'keine Angabe') AS og_name,
  count(*) AS anzahl_insg, count(*) FILTER (verantwortung_janein IS DISTINCT FROM 'Ja') AS anzahl_tn,
  count(*) FILTER (verantwortung_janein = 'Ja') AS anzahl_ma_leitung FROM td
  WHERE NOT EXISTS (SELECT 1 FROM gd WHERE gd.year = td.year AND gd.og_name = td.og_name) GROUP BY ALL),
tot AS (SELECT year, region_grouped, og_region, og_name, anzahl_insg, anzahl_tn, anzahl_ma_leitung FROM gd
  UNION ALL BY NAME SELECT * FROM est),
kon AS (SELECT year, tn_id, CASE WHEN bool_or(kontaktpunkt LIKE 'Ja%') THEN 'Kontakt' ELSE 'Kein Kontakt' END AS has_kontaktpunkt
  FROM contact GROUP BY 1, 2 HAVING bool_or(kontaktpunkt LIKE 'Ja%') OR count(*) = count(kontaktpunkt)),
over_ AS (SELECT tot.*, hat_probleme_tn_gewinnung, hat_hauptamt, auftritte, avg_alter, ages.n FROM tot
  LEFT JOIN (SELECT year, og_name, hat_probleme_tn_gewinnung, hat_hauptamt, auftritte FROM gd) g USING (year, og_name)
  LEFT JOIN ages USING (year, og_name))
"""


def flow(key: str, sql: str):
    """Register a cleaning plan, from landed submissions to a cleaned table, as a query."""
    def run(spark, sf):
        plans = survey(spark, sf)
        if key == "totals":
            return plans.totals
        if key.startswith("raw."):
            return plans.raw[key.removeprefix("raw.")]
        return plans.first[key] if key.startswith("og.") else plans.people[key]

    return query(CTES + sql, name="clean_" + key.replace(".long", "").replace(".", "_"))(run)


# ------------------------------------------------------------ cleaned tables

flow("raw.og.data", """SELECT gd0.*, region_grouped, anzahl_tn + anzahl_ma_leitung AS anzahl_insg
FROM gd0 LEFT JOIN reg USING (og_region)""")
flow("og.data", "SELECT * FROM gd")
flow("raw.og.long.wochentage", "SELECT * FROM days0")
flow("raw.og.long.angebote_vor_ort", "SELECT * FROM gw0")
flow("raw.og.long.gender_by_participant_type", "SELECT * FROM gen0")
flow("raw.og.long.alter_by_participant_type", "SELECT * FROM age0")
flow("raw.og.long.tn_gewinnung_massnahmen", "SELECT * FROM mea0")
flow("raw.og.long.unterstuetzungsbedarfe", "SELECT * FROM need0")
flow("og.long.unterstuetzungsbedarfe", "SELECT * FROM need")
flow("tn.data", "SELECT * FROM td")
flow("tn.wide.aussagen", "SELECT year, tn_id, " + ", ".join(f"{p(f.P3 + n)} AS {n}" for n in STATEMENTS) + " FROM tr")
flow("tn.agg.aussagen", "SELECT * FROM stagg")
flow("tn.agg.alter_by_og", "SELECT * FROM ages")
flow("tn.long.woerter", "SELECT year, tn_id, wort FROM words")
flow("tn.long.eigenschaften", "SELECT * FROM traits")
flow("tn.long.zugangsweg", "SELECT * FROM access")
flow("tn.long.angebote_vor_ort", "SELECT * FROM tw")
flow("tn.long.gruende_dagegen", "SELECT * FROM reasons")
flow("tn.long.hilfsangebote", "SELECT * FROM help")
flow("tn.long.info_wege_aktuell", "SELECT * FROM now")
flow("tn.long.info_wege_wunsch", "SELECT * FROM wish")
flow("tn.long.kontakt_chrgl", "SELECT * FROM contact")
flow("tn.demo.gender", f"SELECT year, {lab(p('block_demografie/gender'), 'gender')} AS gender FROM tr")
flow("tn.demo.alter", "SELECT year, alter FROM tp")
flow("tn.demo.schule", f"SELECT year, {lab(p('block_demografie/schultyp'), 'school')} AS schule FROM tr")
flow("tn.demo.kontakt_chrgl", "SELECT year, kontaktpunkt FROM contact")
flow("tn.demo.kontakt_chrgl_sonst", f"""SELECT year, {p('block_demografie/kontakt_sonst')} AS kontakt_chrgl_sonst FROM tr
WHERE {p('block_demografie/kontakt_sonst')} IS NOT NULL""")
flow("totals", "SELECT * FROM tot")


# ------------------------------------------------------------ result tables


def report(sql: str):
    return query(CTES + sql)


def stacked_sql(source: str, column: str, perc: str, rank: str) -> str:
    """Stack positions of a counted level per edition."""
    return f"""SELECT year, {column}, n, sum(n) OVER (PARTITION BY year ORDER BY {rank} NULLS LAST
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS csum, {perc} AS perc,
  n / 2 + coalesce(sum(n) OVER (PARTITION BY year ORDER BY {rank} NULLS LAST
  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS pos
FROM (SELECT year, {column}, count(*) AS n FROM {source} GROUP BY 1, 2)"""


PERC1 = "round_even(n * 100 / sum(n) OVER (PARTITION BY year), 1)"
PART = "n / sum(n) OVER (PARTITION BY year)"


@report("""SELECT * FROM (SELECT year, count(*) AS og_nach_og, coalesce(sum(anzahl_tn), 0)::BIGINT AS tn_nach_og,
  coalesce(sum(anzahl_ma_leitung), 0)::BIGINT AS leitung_og, coalesce(sum(anzahl_insg), 0)::BIGINT AS insgesamt_og FROM gd GROUP BY 1)
JOIN (SELECT year, count(DISTINCT og_name) AS og_nach_tn, count(*) AS tn_nach_tn,
  count(*) FILTER (verantwortung_janein = 'Nein') AS tn_ohne_verantwortung,
  count(*) FILTER (verantwortung_janein = 'Ja') AS tn_mit_verantwortung FROM td GROUP BY 1) USING (year)""")
def report_key_figures(spark, sf):
    t = tables(spark, sf)
    return network.key_figures(t["og.data"], t["tn.data"])


REGION_GROUPS = """, rg AS (SELECT year, region_grouped, og_region AS og_region_detail, og_name, anzahl_insg, anzahl_tn, anzahl_ma_leitung FROM gd
UNION ALL SELECT year, region_grouped, NULL, og_name, sum(anzahl_insg)::BIGINT, sum(anzahl_tn)::BIGINT, sum(anzahl_ma_leitung)::BIGINT
  FROM est GROUP BY 1, 2, 4)
"""


@report(REGION_GROUPS + """SELECT a.*, slug FROM (SELECT year, region_grouped,
  count(DISTINCT og_name) + max((og_name IS NULL)::INT) AS n_og, sum(anzahl_insg)::BIGINT AS anzahl_insg,
  sum(anzahl_tn)::BIGINT AS anzahl_tn, sum(anzahl_ma_leitung)::BIGINT AS anzahl_ma_leitung FROM rg GROUP BY 1, 2) a
LEFT JOIN (SELECT DISTINCT region_grouped, slug FROM reg) s USING (region_grouped)""")
def report_region_table(spark, sf):
    t = tables(spark, sf)
    return network.region_table(network.region_groups(t["og.data"], t["tn.data"]), f.region_map(spark))


@report(REGION_GROUPS + """SELECT year, CASE WHEN og_region_detail IS NULL THEN og_name ELSE og_name || ' (' || og_region_detail || ')' END
  AS og_name, anzahl_insg, anzahl_tn, anzahl_ma_leitung FROM rg WHERE region_grouped = 'West'""")
def report_region_drilldown(spark, sf):
    t = tables(spark, sf)
    return network.groups_of_region(network.region_groups(t["og.data"], t["tn.data"]), "West", details=True)


def cells_sql(cte: str, column: str) -> str:
    return f"""(SELECT year, person_type, {column}, CASE WHEN count(*) = count(n) THEN sum(n)::BIGINT END AS total
  FROM {cte} GROUP BY 1, 2, 3)"""


def strict_over(frame: str) -> str:
    return f"CASE WHEN count(*) OVER ({frame}) = count(total) OVER ({frame}) THEN sum(total) OVER ({frame}) END"


STACK = "PARTITION BY year, person_type"
BELOW = f"{STACK} ORDER BY gender ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"


@report(f"""SELECT *, ({strict_over(f'{STACK} ORDER BY gender ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING')})::BIGINT AS csum,
  round_even(total * 100 / {strict_over(STACK)}, 1) AS perc, total / 2 + coalesce({strict_over(BELOW)}, 0) AS pos
FROM {cells_sql('gen', 'gender')}""")
def report_gender_shares(spark, sf):
    return network.gender_shares(tables(spark, sf)["og.long.gender_by_participant_type"])


# current and previous edition
SHOWN = "year IN (SELECT max(year) - k FROM gd, range(2) s(k) GROUP BY k)"


def shown(spark: SparkSession, sf: str) -> Column:
    return editions.current_or_previous(survey(spark, sf).years)


@report(f"SELECT *, max(total) OVER () AS max_total FROM {cells_sql('age', 'alter')} WHERE {SHOWN}")
def report_age_totals(spark, sf):
    known = tables(spark, sf)
    return network.age_totals(known["og.long.alter_by_participant_type"], shown(spark, sf))


def engagement_sql(strict: bool) -> str:
    def mean(x: str) -> str:
        return f"CASE WHEN count(*) = count({x}) THEN avg({x}) END" if strict else f"avg({x})"

    return f"""SELECT *, floor(avg_auftritte)::BIGINT AS auftritte_von, ceil(avg_auftritte)::BIGINT AS auftritte_bis FROM
(SELECT year, round_even(avg(hauptamt_stunden), 1) AS ma_avg_stunden, round_even(coalesce(sum(hauptamt_stunden), 0) * 52, 0) AS ma_total_stunden,
  round_even({mean('auftritte')}, 1) AS avg_auftritte FROM gd GROUP BY 1)
JOIN (SELECT year, round_even(avg(stunden_pro_woche), 1) AS tn_avg_stunden,
  round_even(sum(stunden_pro_woche) * 52, 0) AS tn_total_stunden FROM td GROUP BY 1) USING (year)
JOIN (SELECT year, round_even(({mean('stunden')}) * 60, 0) AS avg_dauer_minuten FROM days GROUP BY 1) USING (year)
JOIN (SELECT year, wochentag AS lieblingstag FROM (SELECT year, wochentag, count(*) AS n FROM days GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY year ORDER BY n DESC, wochentag) = 1) USING (year)
JOIN (SELECT year, round_even(avg(s), 1) AS stunden_pro_woche_og, round_even(round_even(avg(s), 1) * 52, 0) AS stunden_pro_jahr_og
  FROM (SELECT year, og_id, coalesce(sum(stunden), 0) AS s FROM days GROUP BY 1, 2) GROUP BY 1) USING (year)"""


@report(engagement_sql(True))
def report_engagement(spark, sf):
    t = tables(spark, sf)
    return network.engagement(t["og.data"], t["tn.data"], t["og.long.wochentage"])


@report(engagement_sql(False))
def report_engagement_known(spark, sf):
    t = tables(spark, sf)
    return network.engagement(t["og.data"], t["tn.data"], t["og.long.wochentage"], skip_missing=True)


HELP = """(SELECT year, hilfsangebot, verantwortung_janein, count(*) AS n FROM help JOIN td USING (year, tn_id)
  WHERE verantwortung_janein IS NOT NULL GROUP BY 1, 2, 3)"""
HELP_PCT = f"(SELECT *, n / sum(n) OVER (PARTITION BY year, verantwortung_janein) AS pct FROM {HELP})"


@report(f"SELECT * FROM {HELP_PCT}")
def report_wanted_help(spark, sf):
    t = tables(spark, sf)
    return network.wanted_help(t["tn.data"], t["tn.long.hilfsangebote"])


@report(f"SELECT * FROM {HELP_PCT} QUALIFY n = max(n) OVER (PARTITION BY year, verantwortung_janein)")
def report_most_wanted_help(spark, sf):
    return network.most_wanted_help(report_wanted_help(spark, sf))


@report(f"SELECT max(pct) AS y_limit FROM {HELP_PCT} WHERE {SHOWN}")
def report_help_limit(spark, sf):
    help_table = report_wanted_help(spark, sf)
    return help_table.filter(shown(spark, sf)).agg(F.max("pct").alias("y_limit"))


@report("""SELECT year, verantwortung_janein, n, round_even(n / sum(n) OVER (PARTITION BY year) * 100, 1) AS perc
FROM (SELECT year, verantwortung_janein, count(*) AS n FROM td GROUP BY 1, 2)""")
def report_responsibility(spark, sf):
    return network.responsibility_shares(tables(spark, sf)["tn.data"])


@report("""SELECT *, max(percent) OVER () AS y_limit FROM (SELECT *, n / sum(n) OVER (PARTITION BY year) AS percent
FROM (SELECT year, wahrsch_empfehlung AS value, count(*) AS n FROM td WHERE wahrsch_empfehlung IS NOT NULL GROUP BY 1, 2))""")
def report_recommendation(spark, sf):
    return network.recommendation(tables(spark, sf)["tn.data"])


def ranked(column: str, levels: list[str]) -> str:
    return f"list_position([{', '.join(repr(x) for x in levels)}], {column})"


@report(stacked_sql("(SELECT year, coalesce(info_komplett, 'keine Angabe') AS info_komplett FROM td)", "info_komplett", PART,
                    ranked("info_komplett", network.COMPLETE_LEVELS)))
def report_info_complete(spark, sf):
    return network.info_complete(tables(spark, sf)["tn.data"])


@report(stacked_sql("(SELECT year, coalesce(info_wege_aenderung, 'keine Angabe') AS info_wege_aenderung FROM td)",
                    "info_wege_aenderung", PART, ranked("info_wege_aenderung", network.CHANGE_LEVELS)))
def report_info_change(spark, sf):
    return network.info_change(tables(spark, sf)["tn.data"])


CHANNELS = [label for _, label in f.CHOICES["channels"]]


def channels_sql(cte: str) -> str:
    return f"""SELECT year, info_weg, n, n_personen, n * 100 / n_personen AS perc FROM (SELECT year, info_weg, sum(n)::BIGINT AS n FROM (
  SELECT year, info_weg, count(*) AS n FROM {cte} GROUP BY 1, 2 UNION ALL SELECT y.year, l.info_weg, 0
  FROM (SELECT DISTINCT year FROM {cte}) y, (SELECT DISTINCT info_weg FROM {cte} WHERE info_weg IS NOT NULL) l) GROUP BY 1, 2)
JOIN (SELECT year, count(DISTINCT tn_id) AS n_personen FROM {cte} GROUP BY 1) USING (year)"""


@report(channels_sql("now"))
def report_info_channels(spark, sf):
    return network.info_channels(tables(spark, sf)["tn.long.info_wege_aktuell"], CHANNELS)


@report(channels_sql("wish"))
def report_info_wishes(spark, sf):
    return network.info_channels(tables(spark, sf)["tn.long.info_wege_wunsch"], CHANNELS)


def participation_sql(x: str) -> str:
    return f"""SELECT year, region_grouped, count(*) FILTER ({x} = 'Ja') AS anz_ja, count(*) FILTER ({x} = 'Nein') AS anz_nein,
  count(*) AS anz_total, avg(({x} = 'Ja')::INT) * 100 AS pct_ja FROM td WHERE region_grouped IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT year, 'Deutschlandweit', NULL, NULL, NULL, round_even(count(*) FILTER ({x} = 'Ja') * 100 / count(*), 1) FROM td GROUP BY 1"""


@report(participation_sql("teilnahme_dtlweit"))
def report_participation_national(spark, sf):
    return network.participation_by_region(tables(spark, sf)["tn.data"], "teilnahme_dtlweit")


@report(participation_sql("teilnahme_og_uebergreifend"))
def report_participation_regional(spark, sf):
    return network.participation_by_region(tables(spark, sf)["tn.data"], "teilnahme_og_uebergreifend")


def comparison_part(x: str, title: str) -> str:
    return f"""SELECT year, n, csum, perc / 100 AS perc, pos, '{title}' AS type_veranst,
  coalesce({x}, 'keine Angabe') AS teilnahme FROM ({stacked_sql('td', x, PERC1, x)})"""


@report(comparison_part("teilnahme_dtlweit", "deutschlandweit") + " UNION ALL "
        + comparison_part("teilnahme_og_uebergreifend", "ortsgruppenübergreifend / regional"))
def report_participation_comparison(spark, sf):
    return network.participation_comparison(tables(spark, sf)["tn.data"])


@report("""SELECT *, n / n_personen AS percent FROM (SELECT year, grund, count(*) AS n FROM reasons JOIN td USING (year, tn_id)
  WHERE teilnahme_og_uebergreifend = 'Nein' OR teilnahme_dtlweit = 'Nein' GROUP BY 1, 2)
JOIN (SELECT year, count(*) AS n_personen FROM td
  WHERE teilnahme_og_uebergreifend = 'Nein' OR teilnahme_dtlweit = 'Nein' GROUP BY 1) USING (year)""")
def report_barriers(spark, sf):
    t = tables(spark, sf)
    return network.barriers(t["tn.data"], t["tn.long.gruende_dagegen"])


NEED_ORDER = {"nein": 1, "eher_nein": 2, "eher_ja": 4, "ja": 5, "unsicher": 3}
NEED_RANK = {"nein": 0, "eher_nein": 1, "eher_ja": 2, "ja": 3, "unsicher": None}


def need_ranks(spark, ranks):
    return c.ranked_choices(f.choice_table(spark), "need", ranks)


def rank_sql(ranks) -> str:
    labels = dict(f.CHOICES["need"])
    return "CASE bedarf_value " + " ".join(
        f"WHEN '{labels[k]}' THEN {v}" for k, v in ranks.items() if v is not None) + " END"


@report(f"""SELECT *, n / n_antwort AS prop FROM (SELECT year, bedarf, bedarf_value, {rank_sql(NEED_ORDER)} AS "order", count(*) AS n,
  sum(count(*)) OVER (PARTITION BY year, bedarf)::BIGINT AS n_antwort FROM need GROUP BY 1, 2, 3)""")
def report_need_distribution(spark, sf):
    return network.need_distribution(
        tables(spark, sf)["og.long.unterstuetzungsbedarfe"], need_ranks(spark, NEED_ORDER)
    )


# -- regions


@report("""SELECT 'og.data' AS name, count(*) AS n FROM gd WHERE region_grouped = 'West'
UNION ALL SELECT 'tn.data', count(*) FROM td WHERE region_grouped = 'West'
UNION ALL SELECT 'og.long.unterstuetzungsbedarfe', count(*) FROM need JOIN gd USING (year, og_id) WHERE region_grouped = 'West'
UNION ALL SELECT 'og.agg.total_tn_by_og', count(*) FROM tot WHERE region_grouped = 'West'
UNION ALL SELECT 'tn.long.zugangsweg', count(*) FROM access JOIN td USING (year, tn_id) WHERE region_grouped = 'West'
UNION ALL SELECT 'tn.agg.alter_by_og', count(*) FROM ages""")
def report_region_slice(spark, sf):
    names = ["og.data", "tn.data", "og.long.unterstuetzungsbedarfe", "og.agg.total_tn_by_og", "tn.long.zugangsweg",
             "tn.agg.alter_by_og"]
    stored = tables(spark, sf)
    part = regions.slice_edition({n: stored[n] for n in names}, "West")
    return union_all([part[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in names])


@report("SELECT * FROM over_")
def report_region_overview(spark, sf):
    t = tables(spark, sf)
    return regions.overview_in_one_pass(t["og.data"], t["tn.agg.counts_by_og"])


W_AGE = "sum(avg_alter * n) / sum(CASE WHEN avg_alter IS NOT NULL THEN n END)"


@report(f"""SELECT year, count(*) FILTER (hat_hauptamt = 'Ja') AS hat_hauptamt, sum(anzahl_insg)::BIGINT AS anzahl_insg,
  sum(anzahl_tn)::BIGINT AS anzahl_tn, sum(anzahl_ma_leitung)::BIGINT AS anzahl_ma_leitung, sum(auftritte)::BIGINT AS auftritte,
  round_even({W_AGE}, 0) AS avg_alter FROM over_ GROUP BY 1""".replace("SELECT year,", "SELECT year, count(DISTINCT og_name) AS n_og,", 1))
def report_overview_footer(spark, sf):
    return regions.overview_footer(report_region_overview(spark, sf))


@report(f"""SELECT year, og_region, count(DISTINCT og_name) AS n_og, coalesce(sum(anzahl_insg), 0)::BIGINT AS anzahl_insg,
  coalesce(sum(anzahl_tn), 0)::BIGINT AS anzahl_tn, coalesce(sum(anzahl_ma_leitung), 0)::BIGINT AS anzahl_ma_leitung,
  coalesce(sum(auftritte), 0)::BIGINT AS auftritte, {W_AGE} AS avg_alter FROM over_ GROUP BY 1, 2""")
def report_subregions(spark, sf):
    return regions.subregion_table(report_region_overview(spark, sf))


LEVEL_SUMS = """count(DISTINCT (year, og_name)) + max((og_name IS NULL)::INT) AS n_og, count(*) FILTER (hat_hauptamt = 'Ja') AS hat_hauptamt,
  coalesce(sum(anzahl_insg), 0)::BIGINT AS anzahl_insg, coalesce(sum(anzahl_tn), 0)::BIGINT AS anzahl_tn,
  coalesce(sum(anzahl_ma_leitung), 0)::BIGINT AS anzahl_ma_leitung, coalesce(sum(auftritte), 0)::BIGINT AS auftritte"""


@report(f"""SELECT CASE grouping(year, region_grouped, og_region) WHEN 0 THEN 'subregion' WHEN 1 THEN 'region' WHEN 3 THEN 'edition' ELSE 'all' END AS level,
  year, region_grouped, og_region, {LEVEL_SUMS}, round_even({W_AGE}, 0) AS avg_alter FROM over_
GROUP BY GROUPING SETS ((), (year), (year, region_grouped), (year, region_grouped, og_region))""")
def report_levels(spark, sf):
    return regions.overview_levels(report_region_overview(spark, sf))


PAIRS = """, all_pairs AS (SELECT year, og_name, angebote_vor_ort AS angebot FROM gw JOIN gd USING (year, og_id)
UNION SELECT year, og_name, angebot FROM tw JOIN td USING (year, tn_id)),
pairs AS (SELECT * FROM all_pairs WHERE og_name IS NOT NULL)
"""


@report(PAIRS + "SELECT * FROM all_pairs")
def report_offered_workshops(spark, sf):
    return tables(spark, sf)["og.agg.angebote"]


WORKSHOPS = ["Andere Workshops", "Chor", "Tanz", "Technik/Licht", "Theater"]


@report(PAIRS + "SELECT year, og_name, " + ", ".join(
    f"max((angebot IS NOT DISTINCT FROM '{w}')::INT) AS \"{w}\"" for w in WORKSHOPS) + " FROM pairs GROUP BY 1, 2")
def report_workshop_matrix(spark, sf):
    return regions.workshop_matrix(tables(spark, sf)["og.agg.angebote"], WORKSHOPS)


@report(PAIRS + """SELECT x.*, r.og_region FROM (SELECT n.year, n.og_name, l.angebot, (q.angebot IS NOT NULL)::INT AS has,
  CASE WHEN q.angebot IS NULL THEN '✗' ELSE '✓' END AS label FROM (SELECT DISTINCT year, og_name FROM pairs) n
  CROSS JOIN (SELECT DISTINCT angebot FROM all_pairs WHERE angebot IS NOT NULL) l
  LEFT JOIN pairs q ON q.year = n.year AND q.og_name = n.og_name AND q.angebot = l.angebot) x
LEFT JOIN (SELECT DISTINCT year, og_name, og_region FROM tot) r USING (year, og_name)""")
def report_workshop_presence(spark, sf):
    t = tables(spark, sf)
    return regions.workshop_presence(t["og.agg.angebote"], t["totals"], WORKSHOPS)


@report("""SELECT year, og_region, angebot, n, n_tn_region, n / n_tn_region AS percent FROM (
  SELECT year, og_region, angebot, sum(n)::BIGINT AS n FROM (
    SELECT year, og_region, angebot, count(*) AS n FROM (SELECT DISTINCT year, tn_id, og_region, angebot FROM tw JOIN td USING (year, tn_id)
      WHERE og_region IS NOT NULL) GROUP BY 1, 2, 3
    UNION ALL SELECT DISTINCT year, og_region, a.angebot, 0 FROM tw JOIN td USING (year, tn_id),
      (SELECT DISTINCT angebot FROM tw WHERE angebot IS NOT NULL) a WHERE og_region IS NOT NULL) GROUP BY 1, 2, 3)
LEFT JOIN (SELECT year, og_region, count(*) AS n_tn_region FROM td WHERE og_region IS NOT NULL GROUP BY 1, 2) USING (year, og_region)""")
def report_workshop_shares(spark, sf):
    t = tables(spark, sf)
    return regions.workshop_shares(t["tn.long.angebote_vor_ort"], t["tn.data"], WORKSHOPS)


@report("""SELECT year, angebot, coalesce(n, 0) AS n, n_tn, coalesce(n, 0) / n_tn AS percent FROM (SELECT year, count(*) AS n_tn FROM td GROUP BY 1)
CROSS JOIN (SELECT unnest(['Andere Workshops', 'Chor', 'Tanz', 'Technik/Licht', 'Theater']) AS angebot)
LEFT JOIN (SELECT year, angebot, count(*) AS n FROM tw GROUP BY 1, 2) USING (year, angebot)""")
def report_workshop_shares_overall(spark, sf):
    t = tables(spark, sf)
    return regions.workshop_shares_overall(t["tn.long.angebote_vor_ort"], t["tn.data"], WORKSHOPS)


@report("""SELECT year, count(DISTINCT tn_id) AS n_gesamt, count(DISTINCT CASE WHEN angebot = 'Theater' THEN tn_id END) AS n_option,
  round_even(count(DISTINCT CASE WHEN angebot = 'Theater' THEN tn_id END) / count(DISTINCT tn_id), 2) AS anteil FROM tw GROUP BY 1""")
def report_theater_share(spark, sf):
    return regions.option_share(tables(spark, sf)["tn.long.angebote_vor_ort"], "angebot", "Theater")


MANUAL = ["Von anderen mitgenommen", "Aufführung gesehen", "Schnupperprobe", "Seminar besucht", "Anderes"]
SPOKEN = ["Andere Person", "Auffuehrung", "Schnupperprobe", "Seminar", "Sonstiges"]
ROUTES = "(SELECT * FROM (VALUES " + ", ".join(
    f"('{label}', '{short}', '{manual}')" for (_, label), short, manual in zip(f.CHOICES["access"], SPOKEN, MANUAL)
) + ") AS w(zugangsweg, label_short, label_manual) WHERE zugangsweg IN (SELECT zugangsweg FROM access)) v"


def routes(spark):
    return c.short_choice_labels(f.choice_table(spark), "access", MANUAL).withColumnRenamed("label", "zugangsweg")


@report(f"""SELECT year, zugangsweg, coalesce(n, 0) AS n, label_short, label_manual, total_n, coalesce(n, 0) / total_n AS prop
FROM (SELECT year, count(*) AS total_n FROM td GROUP BY 1)
CROSS JOIN {ROUTES}
LEFT JOIN (SELECT year, zugangsweg, count(*) AS n FROM access GROUP BY 1, 2) USING (year, zugangsweg)""")
def report_access_shares(spark, sf):
    t = tables(spark, sf)
    access = t["tn.long.zugangsweg"]
    return regions.access_shares(access, t["tn.data"], routes(spark))


@report(f"""SELECT year, og_region, zugangsweg, n, label_short, label_manual, total_n, n / total_n AS prop FROM (
  SELECT year, og_region, zugangsweg, sum(n)::BIGINT AS n FROM (
    SELECT year, og_region, zugangsweg, count(*) AS n FROM access JOIN td USING (year, tn_id) WHERE og_region IS NOT NULL GROUP BY 1, 2, 3
    UNION ALL SELECT DISTINCT year, og_region, v.zugangsweg, 0 FROM access JOIN td USING (year, tn_id),
      {ROUTES} WHERE og_region IS NOT NULL) GROUP BY 1, 2, 3)
LEFT JOIN {ROUTES} USING (zugangsweg)
LEFT JOIN (SELECT year, og_region, count(*) AS total_n FROM td GROUP BY 1, 2) USING (year, og_region)""")
def report_access_shares_by_region(spark, sf):
    t = tables(spark, sf)
    access = t["tn.long.zugangsweg"]
    return regions.access_shares(access, t["tn.data"], routes(spark), "og_region")


MEASURES = "(VALUES ('Flyer verteilen', 'Flyer'), ('Soziale Medien', 'Social Media'), ('Sonstige Maßnahmen', 'Sonstige'), ('Tour', 'Show Tour'))"
MEASURE_COUNTS = f"""(SELECT y.year, massnahme, label_short, coalesce(n, 0) AS n FROM (SELECT DISTINCT year FROM mea) y
  CROSS JOIN {MEASURES} AS v(massnahme, label_short)
  LEFT JOIN (SELECT year, massnahme, count(*) AS n FROM mea GROUP BY 1, 2) USING (year, massnahme))"""


def measure_choices(spark):
    labels = c.short_choice_labels(f.choice_table(spark), "measures")
    return labels.select(F.col("label").alias("massnahme"), "label_short")


@report(f"SELECT * FROM {MEASURE_COUNTS}")
def report_measure_counts(spark, sf):
    return regions.measure_counts(tables(spark, sf)["og.long.tn_gewinnung_massnahmen"], measure_choices(spark))


@report(f"""SELECT m.*, i AS erfolg, 'Erfolg ' || i AS erfolg_label, coalesce(n_erf, 0) AS n_erf,
  CASE WHEN n > 0 THEN coalesce(n_erf, 0) / n END AS perc FROM {MEASURE_COUNTS} m
CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i)
LEFT JOIN (SELECT year, massnahme, erfolg AS i, count(*) AS n_erf FROM mea GROUP BY 1, 2, 3) USING (year, massnahme, i)""".replace(
    "SELECT m.*", "SELECT year, massnahme, label_short, n"))
def report_measure_success(spark, sf):
    ratings = choice_labels(spark, "success", "erfolg", "erfolg_label").withColumn("erfolg", F.col("erfolg").cast("int"))
    return regions.measure_success(
        tables(spark, sf)["og.long.tn_gewinnung_massnahmen"], measure_choices(spark), ratings
    )


PROBLEMS = [label for _, label in f.CHOICES["problems"]]


def percent_sql(y: int) -> str:
    here = f"year = {y}"
    return (f"CASE WHEN count(*) FILTER ({here}) > 0 AND count(*) FILTER ({here} AND x IS NULL) = 0 THEN "
            f"count(*) FILTER ({here} AND x = choice) * 100 / count(*) FILTER ({here}) END AS pct_{y}")


@report(f"""SELECT choice, {percent_sql(2000)}, {percent_sql(1999)} FROM (SELECT year, hat_probleme_tn_gewinnung AS x FROM gd),
(SELECT unnest({PROBLEMS}) AS choice) GROUP BY 1""")
def report_problem_percent(spark, sf):
    return regions.problem_percent(tables(spark, sf)["og.data"], PROBLEMS, [2000, 1999])


@report(f"""SELECT choice, {percent_sql(2000)}, {percent_sql(1999)} FROM (SELECT year, hat_probleme_tn_gewinnung AS x FROM gd
  WHERE hat_probleme_tn_gewinnung IS NOT NULL), (SELECT unnest({PROBLEMS}) AS choice) GROUP BY 1""")
def report_problem_percent_known(spark, sf):
    known = tables(spark, sf)["og.data"].filter(F.col("hat_probleme_tn_gewinnung").isNotNull())
    return regions.problem_percent(known, PROBLEMS, [2000, 1999])


@report("""SELECT *, n / sum(n) OVER (PARTITION BY year, og_region) AS perc FROM (
  SELECT gd.year, gd.og_region, hat_probleme_tn_gewinnung, count(*) AS n FROM gd
  LEFT JOIN (SELECT DISTINCT year, og_name FROM tot) t ON t.year = gd.year AND t.og_name = gd.og_name
  WHERE hat_probleme_tn_gewinnung IS NOT NULL AND gd.og_region IS NOT NULL GROUP BY 1, 2, 3)""")
def report_problems_by_subregion(spark, sf):
    t = tables(spark, sf)
    return regions.problems_by_subregion(t["og.data"], t["totals"])


@report(f"""SELECT year, bedarf, median_bedarf, round(bedarf_mean, 9) AS bedarf_mean, round(sd, 9) AS sd, range, bedarf_label, sd_label,
  {NEED_SENTENCE} AS erklaerung
FROM (SELECT *, CASE WHEN bedarf_mean > 0 AND bedarf_mean <= 1 THEN 'gering' WHEN bedarf_mean > 1 AND bedarf_mean <= 2 THEN 'mittel'
  WHEN bedarf_mean > 2 THEN 'hoch' END AS bedarf_label, CASE WHEN range <= 1 THEN 'konstant' WHEN range <= 3 THEN 'variierend' END AS sd_label
FROM (SELECT year, bedarf, median(o)::DOUBLE AS median_bedarf, avg(o) AS bedarf_mean, stddev_samp(o) AS sd, max(o) - min(o) AS range
  FROM (SELECT year, bedarf, {rank_sql(NEED_RANK)} AS o FROM need) GROUP BY 1, 2))""")
def report_need_table(spark, sf):
    out = regions.need_table(tables(spark, sf)["og.long.unterstuetzungsbedarfe"], need_ranks(spark, NEED_RANK))
    return out.withColumns({"bedarf_mean": F.round("bedarf_mean", 9), "sd": F.round("sd", 9)})


# -- topics


def statement_labels(spark):
    rows = [(r[1], r[6]) for r in f.PERSON_FORM if r[1] in STATEMENTS]
    return local_table(spark, rows, "aussage string, q_label string")


STATEMENT_LABELS = "(VALUES " + ", ".join(
    f"('{r[1]}', '{r[6]}')" for r in f.PERSON_FORM if r[1] in STATEMENTS) + ") AS v(aussage, q_label)"


@report(f"""SELECT year, aussage, value, n, q_label, {lab('value', 'likert')} AS ch_label, n_personen, n / n_personen AS percent
FROM (SELECT year, aussage, value, count(*) AS n FROM stm WHERE value IS NOT NULL GROUP BY 1, 2, 3)
JOIN (SELECT year, count(DISTINCT tn_id) AS n_personen FROM stm GROUP BY 1) USING (year) JOIN {STATEMENT_LABELS} USING (aussage)""")
def report_statement_distribution(spark, sf):
    return topics.statement_distribution(
        tables(spark, sf)["tn.long.aussagen"], statement_labels(spark), choice_labels(spark, "likert", "value", "ch_label")
    )


@report(f"""SELECT year, eig, value, coalesce(n, 0) AS n, {lab('value', 'likert')} AS choice_label, n_personen,
  coalesce(n, 0) / n_personen AS percent FROM (SELECT year, count(DISTINCT tn_id) AS n_personen FROM traits GROUP BY 1)
CROSS JOIN (SELECT unnest({[r[1] for r in TRAITS]}) AS eig) CROSS JOIN (SELECT unnest(['1','2','3','4','5','6']) AS value)
LEFT JOIN (SELECT year, eig, value, count(*) AS n FROM traits GROUP BY 1, 2, 3) USING (year, eig, value)""")
def report_trait_distribution(spark, sf):
    scale = [(r[1], code, label) for r in TRAITS for code, label in f.LIKERT]
    choices = local_table(spark, scale, "eig string, value string, choice_label string")
    return topics.trait_distribution(tables(spark, sf)["tn.long.eigenschaften"], choices)


@report(stacked_sql("kon", "has_kontaktpunkt", PERC1, "has_kontaktpunkt"))
def report_faith_contact(spark, sf):
    return topics.faith_contact_shares(tables(spark, sf)["tn.long.kontakt_chrgl"])


def rated(spark, sf):
    t = tables(spark, sf)
    return topics.faith_rating(t["tn.long.aussagen"], t["tn.long.kontakt_chrgl"], "glaube_spiritualitaet")


RATED = "(SELECT * FROM stm JOIN kon USING (year, tn_id) WHERE aussage = 'glaube_spiritualitaet')"


@report(f"""SELECT *, n / sum(n) OVER (PARTITION BY year) AS percent
FROM (SELECT year, value, count(*) AS n FROM {RATED} WHERE value IS NOT NULL GROUP BY 1, 2)""")
def report_faith_rating(spark, sf):
    return topics.faith_rating_table(rated(spark, sf))


@report(f"SELECT year, count(*) FILTER (value::INT >= 4) / count(value) AS share_eher_yes FROM {RATED} GROUP BY 1")
def report_faith_rating_high(spark, sf):
    return topics.faith_rating_high(rated(spark, sf))


@report(f"""SELECT *, n / sum(n) OVER (PARTITION BY year, has_kontaktpunkt) AS percent
FROM (SELECT year, has_kontaktpunkt, value, count(*) AS n FROM {RATED} WHERE value IS NOT NULL GROUP BY 1, 2, 3)""")
def report_faith_rating_by_contact(spark, sf):
    return topics.faith_rating_by_contact(rated(spark, sf))


@report("""SELECT *, n / sum(n) OVER (PARTITION BY year, has_kontaktpunkt) AS percent
FROM (SELECT year, has_kontaktpunkt, value, count(*) AS n FROM traits JOIN kon USING (year, tn_id)
  WHERE eig = 'eig_offen_religionen' GROUP BY 1, 2, 3)""")
def report_openness_by_contact(spark, sf):
    t = tables(spark, sf)
    return topics.openness_by_contact(t["tn.long.eigenschaften"], t["tn.long.kontakt_chrgl"], "eig_offen_religionen")


@report("SELECT year, wort AS word, count(*) AS freq FROM words GROUP BY 1, 2 HAVING count(*) > 4")
def report_word_cloud(spark, sf):
    return topics.word_cloud(tables(spark, sf)["tn.long.woerter"])


@report("SELECT year, count(DISTINCT tn_id) AS n_personen FROM words GROUP BY 1")
def report_word_answerers(spark, sf):
    return topics.word_answerers(tables(spark, sf)["tn.long.woerter"])


# -- trends


@report("SELECT year, count(DISTINCT og_name) + max((og_name IS NULL)::INT) AS ortsgruppen FROM tot GROUP BY 1")
def report_groups_per_year(spark, sf):
    return trends.groups_per_year(tables(spark, sf)["totals"])


@report("""SELECT r.region_grouped, y.year, coalesce(n.n, 0)::BIGINT AS ortsgruppen, r.rank FROM (
  SELECT region_grouped, row_number() OVER (ORDER BY sum(n) DESC, region_grouped)::INT AS rank FROM (
    SELECT region_grouped, year, count(DISTINCT og_name) AS n FROM tot WHERE region_grouped <> 'keine Angabe' GROUP BY 1, 2) GROUP BY 1) r
CROSS JOIN (SELECT DISTINCT year FROM tot WHERE region_grouped <> 'keine Angabe') y
LEFT JOIN (SELECT region_grouped, year, count(DISTINCT og_name) AS n FROM tot GROUP BY 1, 2) n
  ON n.region_grouped = r.region_grouped AND n.year = y.year""")
def report_groups_per_region(spark, sf):
    return trends.groups_per_year_and_region(tables(spark, sf)["totals"])


def strict(x: str) -> str:
    return f"CASE WHEN count(*) = count({x}) THEN sum({x})::BIGINT END"


@report(f"""SELECT year, {strict('anzahl_tn')} AS teilnehmende, {strict('anzahl_ma_leitung')} AS mitarbeitende,
  {strict('anzahl_insg')} AS insg FROM tot GROUP BY 1""")
def report_people_per_year(spark, sf):
    return trends.people_per_year(tables(spark, sf)["totals"])


@report(f"""SELECT year, 'Teilnehmende' AS gruppe, {strict('anzahl_tn')} AS anzahl FROM tot GROUP BY 1
UNION ALL SELECT year, 'Mitarbeitende', {strict('anzahl_ma_leitung')} FROM tot GROUP BY 1""")
def report_people_per_year_long(spark, sf):
    return trends.people_per_year_long(tables(spark, sf)["totals"])


@report(f"""SELECT *, CASE WHEN count(*) OVER () = count(insg) OVER () THEN max(insg) OVER () END AS y_max
FROM (SELECT year, region_grouped, {strict('anzahl_insg')} AS insg FROM tot GROUP BY 1, 2)""")
def report_people_per_region(spark, sf):
    return trends.people_per_year_and_region(tables(spark, sf)["totals"])


@report("""SELECT *, max(insg) OVER () AS y_max
FROM (SELECT year, region_grouped, coalesce(sum(anzahl_insg), 0)::BIGINT AS insg FROM tot GROUP BY 1, 2)""")
def report_people_per_region_known(spark, sf):
    return trends.people_per_year_and_region(tables(spark, sf)["totals"], skip_missing=True)


@report("SELECT year, coalesce(sum(auftritte), 0)::BIGINT AS auftritte FROM gd GROUP BY 1")
def report_shows(spark, sf):
    return trends.shows_per_year(tables(spark, sf)["og.data"])


@report("SELECT year, count(*) FILTER (teilnahme_dtlweit = 'Ja') AS count FROM td GROUP BY 1")
def report_national_yes(spark, sf):
    return trends.yes_per_year(tables(spark, sf)["tn.data"], "teilnahme_dtlweit")


@report("SELECT year, count(*) FILTER (teilnahme_og_uebergreifend = 'Ja') AS count FROM td GROUP BY 1")
def report_regional_yes(spark, sf):
    return trends.yes_per_year(tables(spark, sf)["tn.data"], "teilnahme_og_uebergreifend")


TITLES = {"kreativ": "Kreativität", "lernen": "Neues lernen"}
TITLE = "CASE aussage WHEN 'kreativ' THEN 'Kreativität' WHEN 'lernen' THEN 'Neues lernen' ELSE "


@report(f"""SELECT stagg.*, q_label AS label, {TITLE} aussage END AS x_label, {TITLE} q_label END AS sort_title
FROM stagg JOIN {STATEMENT_LABELS} USING (aussage)""")
def report_agreement_trend(spark, sf):
    return trends.agreement_per_year(tables(spark, sf)["tn.long.aussagen"], statement_labels(spark), TITLES)


@report("""SELECT year, n_og, n_tn, n_og + n_tn AS n_gesamt FROM (SELECT year, count(*) AS n_og FROM gd GROUP BY 1)
JOIN (SELECT year, count(*) AS n_tn FROM td GROUP BY 1) USING (year)""")
def report_answer_counts(spark, sf):
    t = tables(spark, sf)
    return trends.answer_counts(t["og.data"], t["tn.data"])


def kept_rows(spark, known):
    """First submission of each group, in the editions that are made."""
    regs = f.region_map(spark)
    return lambda stored, submissions: groups.first_of_each_group(
        groups.harmonize_groups(groups.clean_groups(submissions, f.form(spark, "og"), regs)["og.data"], known, regs)
    )


def kept_state(stored, submissions):
    rows = numbered(stored("og.data"), "og_name", ["year"])
    return states(rows, ["year", "region_grouped"], ["anzahl_tn", "anzahl_insg"])


@report("""SELECT CASE grouping(year, region_grouped) WHEN 0 THEN 'region' ELSE 'edition' END AS level, year, region_grouped,
  count(DISTINCT og_name) AS ortsgruppen, CASE WHEN count(*) = count(anzahl_insg) THEN sum(anzahl_insg)::BIGINT END AS insg_strict,
  coalesce(sum(anzahl_tn), 0)::BIGINT AS tn_known FROM gd GROUP BY GROUPING SETS ((year), (year, region_grouped))""")
def report_kept_editions(spark, sf):
    """All editions are landed, the last one without its odd submissions; it is landed again, whole, and only it is made anew."""
    root = f"{ledger.shared_folder(spark)}/editions-{uuid.uuid4().hex}"
    landing, raw = f"{root}/landing", f.group_submissions(spark, sf)
    last = raw.agg(F.max("year")).scalar()

    def land(rows):
        rows.withColumn("edition", F.col("year")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "edition").parquet(landing)

    def bring_up_to_date():
        stored = ledger.Ledger(spark, root).files(landing)
        folders = {int(s.getPath().getName().split("=")[1]): s.getPath().toString() for s in stored if s.isDirectory()}
        return ledger.refresh(
            spark, root, folders, lambda paths: spark.read.schema(raw.schema).parquet(*paths),
            {"og.data": kept_rows(spark, f.spelling_map(spark, sf)), "og.state": kept_state},
        )

    land(raw.filter((F.col("year") < last) | (F.col("_id") % 2 == 0)))
    bring_up_to_date()
    land(raw.filter(F.col("year") == last))
    bring_up_to_date()
    state = merged(ledger.kept_table(spark, root, "og.state"), {"edition": ["year"], "region": ["year", "region_grouped"]})
    return state.select(
        "level", "year", "region_grouped", entities().alias("ortsgruppen"), strict_total("anzahl_insg").alias("insg_strict"),
        known_total("anzahl_tn").alias("tn_known"),
    )


@report("SELECT DISTINCT year FROM td")
def report_editions(spark, sf):
    return editions.editions(tables(spark, sf)["tn.data"])


@report("""SELECT *, rank() OVER (PARTITION BY year ORDER BY n)::INT AS min_rank,
  row_number() OVER (PARTITION BY year ORDER BY n, info_weg)::INT AS stack_order FROM (SELECT year, info_weg, sum(n)::BIGINT AS n FROM (
  SELECT year, info_weg, count(*) AS n FROM wish WHERE info_weg IS NOT NULL GROUP BY 1, 2 UNION ALL
  SELECT y.year, l.info_weg, 0 FROM (SELECT DISTINCT year FROM wish WHERE info_weg IS NOT NULL) y,
  (SELECT unnest(['E-Mail', 'Instagram', 'Post', 'Chat']) AS info_weg) l) GROUP BY 1, 2)""")
def report_year_chart(spark, sf):
    wish = tables(spark, sf)["tn.long.info_wege_wunsch"].filter(F.col("info_weg").isNotNull())
    n = wish.groupBy("year", "info_weg").agg(F.count(F.lit(1)).alias("n"))
    return year_chart(n, "year", "n", "info_weg", CHANNELS)
