"""Question catalog: from form metadata to named answer columns.

A form has some hundred rows.  Searching it is a small Spark job; the found
rows are then held on the driver (checked against MAX_FORM_ROWS), because
column names have to be known before a query over the answers can be planned.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.local import local_table
from ..functions.missing import quoted
from ..functions.text import option_of_rule, scale_label, spoken_code, without_number_suffix
from .windows import marker_blocks, number_rows

# Rows that a form may have at most, unless the caller says otherwise.
MAX_FORM_ROWS = 20_000

CATALOG_COLUMNS = [
    "q_key", "ord", "name", "kuid", "type", "col_name", "autoname", "label",
    "list_name", "matrix_list", "relevant",
]


def form_scale(df: DataFrame, max_rows: int | None = None) -> list[Row]:
    """Rows of a form's metadata on the driver; more than `max_rows` (MAX_FORM_ROWS) are an error."""
    limit = MAX_FORM_ROWS if max_rows is None else max_rows
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: not the metadata of one form")
    return rows


class QuestionError(LookupError):
    """A search found no question, or not exactly one."""


def _hits(meta: DataFrame, column: str, regex: str, type_filter: str | None) -> DataFrame:
    found = meta.filter(quoted(column).rlike(regex))
    return found.filter(F.col("type") == type_filter) if type_filter else found


def find_questions(
    meta: DataFrame, column: str, regex: str, type_filter: str | None = None
) -> DataFrame:
    """Form rows whose column contains the pattern; at least one."""
    found = _hits(meta, column, regex, type_filter)
    if found.isEmpty():
        raise QuestionError(f"no question for {regex!r} in {column}, type {type_filter}")
    return found


def find_question(
    meta: DataFrame, column: str, regex: str, type_filter: str | None = None
) -> DataFrame:
    """Form rows whose column contains the pattern; exactly one."""
    found = _hits(meta, column, regex, type_filter)
    n = len(found.limit(2).collect())
    if n != 1:
        raise QuestionError(
            f"{'no' if n == 0 else 'more than one'} question for {regex!r} in {column}, type {type_filter}"
        )
    return found


@dataclass(frozen=True)
class Question:
    """How to find one question (or, with many=True, a block of them) in a form."""

    key: str
    column: str
    regex: str
    type: str | None = None
    many: bool = False
    contains: tuple[str, str] | None = None
    lacks: tuple[str, str] | None = None
    cut_suffix: bool = False

    def matches(self) -> Column:
        test = quoted(self.column).rlike(self.regex)
        if self.type:
            test &= F.col("type") == self.type
        if self.contains:
            test &= quoted(self.contains[0]).rlike(self.contains[1])
        if self.lacks:
            test &= ~quoted(self.lacks[0]).rlike(self.lacks[1])
        return test


# Search patterns of the yearly group form.
GROUP_QUESTIONS = [
    Question("wochentag", "name", "Wochentag"),
    Question("wochentag_stunden", "name", ".+?_[sS]tunden", many=True),
    Question("auftritte", "label", "Auftritte.+?Schuljahr"),
    Question("workshops", "name", "angebote_vor_ort"),
    Question("hauptamt", "label", "hauptberuflich"),
    Question("hauptamt_stunden", "name", "Hauptamt_Wochenstunden"),
    Question("anzahl_begin", "label", "Wie viele Personen.+aktiv?"),
    Question("anzahl_ma", "col_name", "Mitarbeitende_inkl_Leitung"),
    Question("anzahl_tn", "col_name", "Teilnehmende_002", cut_suffix=True),
    Question("geschlecht", "label", "identifizieren"),
    Question("geschlecht_begin", "type", "begin_kobomatrix", contains=("label", "Geschlecht")),
    Question("altersgruppe", "col_name", "Altersgruppe"),
    Question("alter_begin", "type", "begin_kobomatrix", contains=("label", "Alter")),
    Question("gewinnung_probleme", "col_name", "[Gg]ewinnung.+?[Pp]robleme"),
    Question("gewinnung_massnahmen", "col_name", "[Gg]ewinnung.+?[Mm]assnahmen$"),
    Question("gewinnung_massnahmen_sonst", "col_name", "[Gg]ewinnung.+?[Mm]assnahmen_sons(t)*$"),
    Question("gewinnung_erfolg_begin", "col_name",
             "(Erfolg.+?[Mm]assnahm)|block_erfolg_tngewinnung",
             many=True, contains=("name", "header")),
    Question("gewinnung_erfolg", "col_name",
             "(Erfolg.+?[Mm]assnahm)|block_erfolg_tngewinnung",
             type="select_one", many=True, lacks=("name", "header")),
    Question("bedarfe_begin", "col_name", "[Uu]nterstuetzungsbedarfe", type="begin_group", many=True),
    Question("bedarfe", "col_name", "[Uu]nterstuetzungsbedarfe", type="select_one", many=True,
             lacks=("col_name", "header")),
    Question("bedarfe_weitere", "col_name", "[wW]eitereUnters"),
    Question("region", "col_name", "region$"),
    Question("name", "col_name", "ortsgruppe_name$"),
]

# Search patterns of the yearly person form, and its age limit.
PERSON_QUESTIONS = [
    Question("wort_begin", "label", "Wort", type="begin_group", many=True),
    Question("worte", "col_name", "Wort", many=True),
    Question("eigenschaften_begin", "label", "Eigenschaften", type="begin_group"),
    Question("eigenschaften", "col_name", "block_eigenschaften", type="select_one", many=True),
    Question("offenheit", "col_name", "religion"),
    Question("zugangsweg", "col_name", "zugangsweg", type="select_multiple"),
    Question("zugangsweg_sonst", "col_name", "zugangsweg", type="text"),
    Question("aussagen_begin", "col_name", "aussage", many=True, contains=("name", "header")),
    Question("aussagen", "col_name", "aussage", type="select_one", many=True, lacks=("name", "header")),
    Question("angebote", "label", "An welchen Angeboten"),
    Question("angebote_sonst", "col_name", "andere_angebote"),
    Question("stunden", "label", "Stunden"),
    Question("name", "label", "heißt.+?Ortsgruppe"),
    Question("region", "col_name", "ortsgruppe_region"),
    Question("veranst_regional", "label", "ortsgruppenübergreifenden"),
    Question("veranst_national", "label", "Warst du.+?deutschlandweit"),
    Question("huerden", "label", "deutschlandweit.+?gegen.+?Gründe"),
    Question("huerden_andere", "col_name", "gruende.+?andere"),
    Question("verantwortung", "label", r"Übernimmst.+?Verantwortung\?$"),
    Question("hilfe", "label", "helfen.+?Verantwortung"),
    Question("hilfe_sonst", "relevant", "hilfe_fuer_verantw", type="text"),
    Question("info_aktuell", "col_name", "informationswege_derzeit"),
    Question("info_komplett", "col_name", "informationen_komplett"),
    Question("info_aenderung", "label", "Wenn du es dir aussuchen.+?Informationen.+?", type="select_one"),
    Question("info_wunsch", "label", "Wenn du es dir aussuchen.+?Informationen.+?", type="select_multiple"),
    Question("empfehlung", "label", "empfiehlst"),
    Question("gender", "label", "Geschlecht"),
    Question("alter", "label", "Alter"),
    Question("schule", "col_name", "demo.+?[Ss]chul"),
    Question("glaube_kontakt", "label", "Kontakt.+?christlichen"),
    Question("glaube_kontakt_sonst", "label", "andere Kontaktpunkte"),
]
MAX_AGE = 99


def eigenschaften_by_block(meta: DataFrame, specs: Sequence[Question]) -> list[Question]:
    """Person form specs with the trait block searched by its real group name."""
    begin = find_question(meta, "label", "Eigenschaften", "begin_group").collect()[0]["name"]
    return [
        Question(q.key, q.column, re.escape(begin), q.type, q.many) if q.key == "eigenschaften" else q
        for q in specs
    ]


def build_catalog(meta: DataFrame, specs: Sequence[Question]) -> DataFrame:
    """One row per (question key, form row): all searches in one pass over the form."""
    keys = F.array_compact(F.array(*[F.when(q.matches(), F.lit(q.key)) for q in specs]))
    return meta.withColumn("q_key", F.explode(keys)).select(
        *[c for c in ("year", "survey") if c in meta.columns],
        *CATALOG_COLUMNS,
    )


@dataclass
class Catalog:
    """Found questions of one form, keyed by question."""

    rows: Mapping[str, list[Row]]
    cut: frozenset[str] = field(default_factory=frozenset)

    def __contains__(self, key: str) -> bool:
        return key in self.rows

    def all(self, key: str) -> list[Row]:
        if key not in self.rows:
            raise QuestionError(f"no question for {key!r}")
        return self.rows[key]

    def one(self, key: str) -> Row:
        found = self.all(key)
        if len(found) != 1:
            raise QuestionError(f"{len(found)} questions for {key!r}, one expected")
        return found[0]

    def column(self, key: str) -> str:
        name = self.one(key)["col_name"]
        return without_number_suffix(name) if key in self.cut else name

    def columns(self, key: str) -> list[str]:
        return [r["col_name"] for r in self.all(key)]

    def list_name(self, key: str) -> str:
        names = {r["list_name"] for r in self.all(key)}
        if len(names) != 1:
            raise QuestionError(f"{len(names)} choice lists for {key!r}, one expected")
        return names.pop()

    def answer_columns(self) -> list[str]:
        """Columns of all closed and open questions of the catalog."""
        asked = ("select_one", "select_multiple", "text", "integer", "decimal")
        return list(dict.fromkeys(
            without_number_suffix(r["col_name"]) if k in self.cut else r["col_name"]
            for k, rows in self.rows.items() for r in rows
            if r["type"] in asked and r["col_name"]
        ))


def load_catalog(meta: DataFrame, specs: Sequence[Question], max_rows: int | None = None) -> Catalog:
    """Search one form and check how many rows each question found."""
    found = form_scale(build_catalog(meta, specs).orderBy("ord"), max_rows)
    rows: dict[str, list[Row]] = {}
    for r in found:
        rows.setdefault(r["q_key"], []).append(r)
    for q in specs:
        n = len(rows.get(q.key, []))
        if n == 0 or (n > 1 and not q.many):
            raise QuestionError(f"{n} questions for {q.key!r} ({q.regex!r} in {q.column})")
    return Catalog(rows, frozenset(q.key for q in specs if q.cut_suffix))


@dataclass
class Choices:
    """Answer options of one form: list name to ordered (code, label) pairs."""

    lists: Mapping[str, list[tuple[str, str]]]

    def mapping(self, list_name: str) -> dict[str, str]:
        if list_name not in self.lists:
            return {}
        return dict(self.lists[list_name])

    def levels(self, list_name: str) -> list[str]:
        return [label for _, label in self.lists.get(list_name, [])]


def load_choices(choices: DataFrame, max_rows: int | None = None) -> Choices:
    rows = form_scale(choices.orderBy("list_name", "ord"), max_rows)
    lists: dict[str, list[tuple[str, str]]] = {}
    for r in rows:
        pairs = lists.setdefault(r["list_name"], [])
        if r["name"] in dict(pairs):
            raise ValueError(f"code {r['name']!r} twice in choice list {r['list_name']!r}")
        pairs.append((r["name"], r["label"]))
    return Choices(lists)


def mapping_of(choices: DataFrame, list_name: str) -> DataFrame:
    """Code and label of one choice list, as a table."""
    if not isinstance(list_name, str):
        raise ValueError("one choice list name expected")
    return choices.filter(F.col("list_name") == list_name).select("name", "label")


def extend_mapping(mapping: DataFrame, name: str, label: str) -> DataFrame:
    """Mapping with one more, synthetic option."""
    extra = local_table(mapping.sparkSession, [(name, label)], "name string, label string")
    return mapping.unionByName(extra)


def patch_mapping(mapping: DataFrame, name: str, label: str) -> DataFrame:
    """Mapping with the label of one code replaced."""
    new = F.when(F.col("name") == name, F.lit(label)).otherwise(F.col("label"))
    return mapping.withColumn("label", new)


def ranked_choices(choices: DataFrame, list_name: str, ranks: Mapping[str, int | None]) -> DataFrame:
    """Labels of a list with a rank given per code; codes without rank get NULL."""
    rank = F.lit(None).cast("int")
    for code, r in ranks.items():
        rank = F.when(F.col("name") == code, F.lit(r).cast("int")).otherwise(rank)
    return mapping_of(choices, list_name).select("name", "label", rank.alias("rank"))


def matrix_headers(meta: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Header questions of every matrix, with the kuid of the matrix they belong to."""
    kind = F.col("type")
    return marker_blocks(
        meta, by, "ord",
        kind == "begin_kobomatrix", kind == "end_kobomatrix", F.col("kuid"), "matrix",
    )


def matrix_columns(columns: Sequence[str], block: str) -> list[str]:
    """Answer columns of a matrix: those that carry the block name."""
    return [c for c in columns if re.search(block, c)]


def matrix_cell_list(
    columns: Sequence[str],
    headers: Sequence[tuple[str, str]],
    options: Sequence[tuple[str, str]],
) -> list[tuple[str, str, str]]:
    """(column, header label, option label) of every column that names a header and an option.

    A column that names two headers or two options is an error: its numbers
    would be counted twice.
    """
    cells = []
    for c in columns:
        found = [(header, option) for code, option in options if re.search(code, c)
                 for name, header in headers if re.search(name, c)]
        if len(found) > 1:
            raise QuestionError(f"matrix column {c!r} matches {len(found)} cells: {found}")
        cells += [(c, *cell) for cell in found]
    return cells


def option_codes(meta: DataFrame, default: str = "insgesamt") -> DataFrame:
    """Option code of each conditional question, read from its skip rule."""
    return meta.withColumn("option", option_of_rule("relevant", default))


def rule_option(relevant: str | None, default: str = "insgesamt") -> str:
    """Driver-side twin of option_codes for one catalog row."""
    hit = re.search("'([^']+)'", relevant or "")
    return hit.group(1) if hit else default


def short_choice_labels(choices: DataFrame, list_name: str, manual: Sequence[str] | None = None) -> DataFrame:
    """Label, spoken code and optional hand-written label of each option, in the order of the form."""
    listed = choices.filter(F.col("list_name") == list_name)
    found = form_scale(listed.select("ord", "label", spoken_code("name").alias("label_short")))
    by_hand = dict(enumerate(manual or ()))
    rows = [(r["label"], r["label_short"], by_hand.get(i)) for i, r in enumerate(sorted(found, key=lambda r: r["ord"]))]
    return local_table(choices.sparkSession, rows, "label string, label_short string, label_manual string")


def trait_scales(traits: DataFrame, intro: str) -> DataFrame:
    """Trait questions with the short scale label and their row number."""
    return number_rows(traits.withColumn("label_short", scale_label("label", intro)), "ord")


def source_labels(catalog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Question texts behind a result, one line per question key."""
    used = catalog.filter(F.col("q_key").isin(list(keys)))
    texts = F.array_sort(F.collect_list(F.struct("ord", "label")))
    return used.groupBy("q_key").agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.concat_ws("\n", F.transform(texts, lambda x: x["label"])).alias("questions"),
    )
