"""A small yearly survey: its two forms, and submissions derived from the tables.

Every order is read as a person's submission and every customer as a group's
submission.  Answers are derived from keys and columns by expressions that mean
the same in Spark SQL and in ANSI SQL, so both sides start from the same raw
text; everything after that is computed independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.operators import catalog as c
from canvass.plans.groups import Form, load_form

from .registry import table

BRAND_WORDS = ["singkreis", "sing kreis", "sing-kreis"]

META_SCHEMA = (
    "ord int, name string, type string, kuid string, col_name string, autoname string, label string, "
    "list_name string, matrix_list string, relevant string"
)


def _rows(block: list[tuple]) -> list[tuple]:
    """(type, path, label, list, rule, kuid) to metadata rows in form order."""
    out = []
    for i, (kind, path, label, listed, rule, kuid) in enumerate(block):
        name = path.rsplit("/", 1)[-1] if path else None
        matrix = kind == "begin_kobomatrix"
        out.append(
            (i, name, kind, kuid or f"q{i}", path, name, label,
             None if matrix else listed, listed if matrix else None, rule)
        )
    return out


def q(kind, path, label=None, listed=None, rule=None, kuid=None):
    return (kind, path, label, listed, rule, kuid)


A, D, E, S, B, W = (
    "block_activities/", "block_aktive_details/", "block_erfolg_tngewinnung/", "unterstuetzungsbedarfe/",
    "block_tngewinnung/", "block_region_ortsgruppe/",
)

GROUP_FORM = _rows([
    q("start", "start"), q("end", "end"),
    q("select_multiple", A + "F1_Wochentage", "An welchen Tagen trefft ihr euch?", "days"),
    q("decimal", A + "Montag_Stunden", "Wie viele Stunden montags?", rule="selected(${F1_Wochentage}, 'montag')"),
    q("decimal", A + "dienstag_stunden", "Wie viele Stunden dienstags?", rule="selected(${F1_Wochentage}, 'dienstag')"),
    q("decimal", A + "freitag_stunden", "Wie viele Stunden freitags?", rule="selected(${F1_Wochentage}, 'freitag')"),
    q("integer", A + "F2_Anzahl_Auftritte", "Wie viele Auftritte hattet ihr im letzten Schuljahr?"),
    q("select_multiple", A + "angebote_vor_ort", "Welche Workshops gibt es?", "workshops"),
    q("select_one", A + "F4_Hauptamt", "Gibt es eine hauptberufliche Person?", "staff"),
    q("decimal", A + "Hauptamt_Wochenstunden", "Mit wie vielen Stunden?"),
    q("begin_group", "block_aktive", "Wie viele Personen waren aktiv?"),
    q("decimal", "block_aktive/Mitarbeitende_inkl_Leitung", "Mitarbeitende"),
    q("decimal", "block_aktive/Teilnehmende_002", "Teilnehmende"),
    q("end_group", None),
    q("note", D + "Personen_je_Angabe", "Wie viele identifizieren sich wie?"),
    q("begin_kobomatrix", D + "block_gender", "Geschlecht:", "m_gender", kuid="gm"),
    q("integer", D + "mitarbeitende", "Mitarbeitende (inkl. Leitung)"),
    q("integer", D + "teilnehmende", "Teilnehmende"),
    q("end_kobomatrix", None, kuid="/gm"),
    q("note", D + "Wie_viele_Altersgruppen", "Wie viele je Altersgruppe?"),
    q("begin_kobomatrix", D + "group_jahre", "Alter:", "m_age", kuid="am"),
    q("integer", D + "mitarbeitende", "Mitarbeitende (inkl. Leitung)"),
    q("integer", D + "teilnehmende", "Teilnehmende"),
    q("end_kobomatrix", None, kuid="/am"),
    q("select_one", B + "tngewinnung_probleme", "Gibt es Probleme?", "problems"),
    q("select_multiple", B + "tngewinnung_massnahmen", "Welche Maßnahmen?", "measures"),
    q("text", B + "tngewinnung_massnahmen_sonst", "Welche sonst?"),
    q("select_one", E + "erfolg_header", "Wie erfolgreich?", "success"),
    q("select_one", E + "insgesamt", "Insgesamt", "success"),
    q("select_one", E + "flyer", "Flyer", "success", "selected(${tngewinnung_massnahmen}, 'flyer')"),
    q("select_one", E + "social_media", "Social Media", "success", "selected(${tngewinnung_massnahmen}, 'social_media')"),
    q("select_one", E + "sonstige", "Sonstige", "success", "selected(${tngewinnung_massnahmen}, 'sonstige')"),
    q("begin_group", "unterstuetzungsbedarfe", "Bedarfe"),
    q("select_one", S + "bedarf_header", "Wo braucht ihr Hilfe?", "need"),
    q("select_one", S + "technik", "Technik", "need"),
    q("select_one", S + "geld", "Geld", "need"),
    q("select_one", S + "werbung", "Werbung", "need"),
    q("text", "weitereUnterstuetzung", "Was noch?"),
    q("select_one", W + "region", "Region?", "regions"),
    q("text", W + "ortsgruppe_name", "Name?"),
])

P1, P2, P3, P4, P5, P6 = (
    "blog_worte/", "blog_worte/block_eigenschaften/", "block_aussagen/", "block_engagement/",
    "block_ortsuebergreifend/", "block_gruppe/",
)

PERSON_FORM = _rows([
    q("start", "start"), q("end", "end"),
    q("begin_group", "blog_worte", "Welche Wort-Ideen hast du?"),
    q("text", P1 + "Wort_1", "Erstes"), q("text", P1 + "Wort_2", "Zweites"), q("text", P1 + "Wort_3", "Drittes"),
    q("begin_group", "blog_worte/block_eigenschaften", "Eigenschaften"),
    q("select_one", P2 + "eig_gemeinschaft", 'Bei uns gilt auf einer Skala von "Alle helfen" bis "Jeder allein":', "sc_a"),
    q("select_one", P2 + "eig_offen_religionen", 'Wir sind auf einer Skala zwischen "Offen" und "Eng":', "sc_b"),
    q("select_one", P2 + "eig_ausprobieren", 'Bei uns gilt auf einer Skala von "Neues" bis "Altes":', "sc_c"),
    q("select_multiple", "block_zugang/zugangsweg", "Wie kamst du her?", "access"),
    q("text", "block_zugang/zugangsweg_sonst", "Wie sonst?"),
    q("select_one", P3 + "aussagen_header", "Was trifft zu?", "likert"),
    q("select_one", P3 + "kreativ", "Ich kann kreativ sein.", "likert"),
    q("select_one", P3 + "lernen", "Ich kann lernen.", "likert"),
    q("select_one", P3 + "glaube_spiritualitaet", "Ich denke über Glauben nach.", "likert"),
    q("select_one", P3 + "transfer", "Ich nutze es im Alltag.", "likert"),
    q("select_multiple", P4 + "angebote_vor_ort", "An welchen Angeboten nimmst du teil?", "workshops"),
    q("text", P4 + "andere_angebote_vor_ort", "Welche anderen?"),
    q("decimal", P4 + "zeit_pro_woche", "Wie viele Stunden pro Woche?"),
    q("select_one", P4 + "ortsgruppe_region", "Welche Region?", "regions"),
    q("text", P4 + "ortsgruppe_name", "Wie heißt deine Ortsgruppe?"),
    q("select_one", P5 + "veranst_region", "Warst du bei ortsgruppenübergreifenden Treffen?", "yesno"),
    q("select_one", P5 + "veranst_weit", "Warst du bei einem deutschlandweiten Treffen?", "yesno"),
    q("select_multiple", P5 + "gruende_gegen", "Falls nicht deutschlandweit: was sprach dagegen? Gründe:", "reasons"),
    q("text", P5 + "gruende_gegen_andere", "Andere?"),
    q("select_one", P6 + "verantwortung", "Übernimmst du Verantwortung?", "yesno"),
    q("select_multiple", P6 + "hilfe_fuer_verantwortung", "Was würde helfen, Verantwortung zu tragen?", "help"),
    q("text", P6 + "hilfe_fuer_verantwortung_sonst", "Was sonst?", rule="selected(${hilfe_fuer_verantwortung}, 'sonstiges')"),
    q("select_multiple", P6 + "informationswege_derzeit", "Woher erfährst du etwas?", "channels"),
    q("select_one", P6 + "informationen_komplett", "Erfährst du alles?", "complete"),
    q("select_one", P6 + "info_aenderung", "Wenn du es dir aussuchen kannst: Informationen wie?", "change"),
    q("select_multiple", P6 + "info_wunsch", "Wenn du es dir aussuchen kannst: Informationen wo?", "channels"),
    q("select_one", P6 + "weiterempfehlung", "Wie wahrscheinlich empfiehlst du uns?", "zero_ten"),
    q("select_one", "block_demografie/gender", "Geschlecht", "gender"),
    q("integer", "block_demografie/jahre", "Alter"),
    q("select_one", "block_demografie/schultyp", "Schule", "school"),
    q("select_multiple", "block_demografie/kontakt", "Hast du Kontakt zum christlichen Glauben?", "contact"),
    q("text", "block_demografie/kontakt_sonst", "Welche andere Kontaktpunkte?"),
])

LIKERT = [(str(i), f"Stufe {i}") for i in range(1, 7)]
CHOICES: dict[str, list[tuple[str, str]]] = {
    "days": [("montag", "Montag"), ("dienstag", "Dienstag"), ("freitag", "Freitag")],
    "workshops": [("chor", "Chor"), ("theater", "Theater"), ("technik_licht", "Technik/Licht"),
                  ("andere_workshops", "Andere Workshops")],
    "staff": [("ja_voll", "Ja"), ("nein", "Nein")],
    "m_gender": [("weiblich_1", "weiblich"), ("maennlich_1", "männlich"), ("divers_1", "divers")],
    "m_age": [("bis13_1", "Bis 13 Jahre"), ("14bis17_1", "14-17 Jahre"), ("ab18_1", "18 Jahre und älter")],
    "problems": [("nein", "Nein"), ("phase", "Ja, aber nur phasenweise"), ("gross", "Ja, sehr große Probleme")],
    "measures": [("flyer", "Flyer verteilen"), ("social_media", "Soziale Medien"), ("sonstige", "Sonstige Maßnahmen"),
                 ("show_tour", "Tour")],
    "success": [(str(i), f"Erfolg {i}") for i in range(1, 7)],
    "need": [("nein", "nein"), ("eher_nein", "eher nein"), ("eher_ja", "eher ja"), ("ja", "ja"), ("unsicher", "bin mir unsicher")],
    "regions": [("nord", "Nord"), ("sued", "Süden"), ("ost", "Ostwerk"), ("hessen", "Hessen"),
                ("owl", "Ostwestfalen-Lippe (OWL)"), ("anhalt", "Anhalt")],
    "sc_a": LIKERT, "sc_b": LIKERT, "sc_c": LIKERT, "likert": LIKERT,
    "access": [("andere_person", "Mitgenommen"), ("auffuehrung", "Aufführung"), ("schnupperprobe", "Probe"),
               ("seminar", "Seminar"), ("sonstiges", "Sonstiges")],
    "yesno": [("ja", "Ja"), ("nein", "Nein")],
    "reasons": [("keine_zeit", "Keine Zeit"), ("kosten", "Zu teuer"), ("andere_gr_nde", "Andere Gründe")],
    "help": [("schulung", "Schulungen"), ("begleitung", "Begleitung"), ("sonstiges", "Sonstiges")],
    "channels": [("mail", "E-Mail"), ("insta", "Instagram"), ("post", "Post"), ("chat", "Chat")],
    "complete": [("ja", "ja"), ("teils", "zum Teil"), ("nein", "nein")],
    "change": [("gleich", "Genau wie bisher auch"), ("anders", "Auf anderem Weg, und zwar:")],
    "zero_ten": [(str(i), str(i)) for i in range(11)],
    "gender": [("w", "weiblich"), ("m", "männlich"), ("d", "divers")],
    "school": [("gym", "Gymnasium"), ("real", "Realschule")],
    "contact": [("ja_gemeinde", "Ja, Gemeinde"), ("ja_andere", "Ja, andere"), ("nein", "Nein")],
}

REGIONS = [
    ("Nord", "Nord", "nord"), ("Süden", "Süden", "sueden"), ("Ostwerk", "Ostwerk", "ostwerk"),
    ("Hessen", "West", "west"), ("Ostwestfalen-Lippe", "West", "west"),
]


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def ticks(*options: tuple[str, str]) -> str:
    whens = ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in options)
    return f"nullif(concat_ws(' ', {whens}), '')"


def person_answers() -> dict[str, str]:
    k, cu = "o_orderkey", "o_custkey"
    g = s(f"CAST(floor({cu} / 14) AS BIGINT)")
    out = {
        P1 + "Wort_1": "lower(substring(o_orderpriority, 3))",
        P1 + "Wort_2": "CASE o_orderstatus WHEN 'F' THEN 'freunde' WHEN 'O' THEN 'musik' END",
        P1 + "Wort_3": f"CASE WHEN {cu} % 5 = 0 THEN concat('wort', {s(f'{cu} % 97')}) END",
        "block_zugang/zugangsweg": ticks(
            ("andere_person", f"{k} % 2 = 0"), ("auffuehrung", f"{k} % 3 = 0"),
            ("schnupperprobe", f"{cu} % 4 = 0"), ("sonstiges", f"{k} % 7 = 0"), ("alter_code", f"{k} % 31 = 0")),
        "block_zugang/zugangsweg_sonst": f"CASE WHEN {k} % 14 = 0 OR {cu} % 50 = 0 THEN concat('weg ', {s(cu)}) END",
        P4 + "angebote_vor_ort": ticks(
            ("chor", f"{k} % 2 = 1"), ("theater", f"{cu} % 3 = 0"), ("technik___licht", f"{k} % 5 = 0"),
            ("andere_workshops", f"{k} % 10 < 3"), ("alt", f"{k} % 37 = 0")),
        P4 + "andere_angebote_vor_ort": f"CASE WHEN {k} % 10 = 1 THEN concat('kurs ', {s(f'{cu} % 9')}) END",
        P4 + "zeit_pro_woche": f"CASE WHEN {k} % 13 = 0 THEN 'viele' WHEN {k} % 17 = 0 THEN NULL "
                               f"ELSE concat({s(f'({k} + {cu}) % 50')}, '.5') END",
        P4 + "ortsgruppe_region": f"CASE {cu} % 8 WHEN 0 THEN 'nord' WHEN 1 THEN 'sued' WHEN 2 THEN 'ost' "
                                  f"WHEN 3 THEN 'hessen' WHEN 4 THEN 'owl' WHEN 5 THEN 'anhalt' WHEN 7 THEN 'xx' END",
        P4 + "ortsgruppe_name": f"CASE WHEN {k} % 19 = 0 THEN '' WHEN {k} % 23 = 0 THEN NULL "
                                f"WHEN {k} % 31 = 0 THEN concat('Grp ', {g}) "
                                f"WHEN {k} % 3 = 0 THEN concat('SingKreis Gruppe ', {g}) "
                                f"WHEN {k} % 3 = 1 THEN concat('gruppe ', {g}, ' sing-kreis') ELSE concat('Gruppe ', {g}) END",
        P5 + "veranst_region": f"CASE {k} % 5 WHEN 0 THEN 'ja' WHEN 1 THEN 'nein' WHEN 2 THEN 'nein' WHEN 3 THEN 'ja' END",
        P5 + "veranst_weit": f"CASE ({cu} + {k}) % 4 WHEN 0 THEN 'ja' WHEN 1 THEN 'nein' WHEN 2 THEN 'nein' END",
        P5 + "gruende_gegen": ticks(
            ("keine_zeit", f"{k} % 3 = 1"), ("kosten", f"{cu} % 3 = 0"), ("andere_gr_nde", f"{k} % 8 = 0")),
        P5 + "gruende_gegen_andere": f"CASE WHEN {k} % 16 = 0 THEN concat('weil ', {s(f'{cu} % 5')}) END",
        P6 + "verantwortung": f"CASE WHEN {k} % 7 < 3 THEN 'ja' WHEN {k} % 7 < 6 THEN 'nein' END",
        P6 + "hilfe_fuer_verantwortung": ticks(
            ("schulung", f"{k} % 2 = 0"), ("begleitung", f"{cu} % 2 = 0"), ("sonstiges", f"{k} % 9 = 0")),
        P6 + "hilfe_fuer_verantwortung_sonst": f"CASE WHEN {k} % 18 = 0 THEN 'mehr Zeit' END",
        P6 + "informationswege_derzeit": ticks(
            ("mail", f"{k} % 3 = 0"), ("insta", f"{cu} % 2 = 0"), ("post", f"{k} % 20 = 0"), ("fax", f"{k} % 33 = 0")),
        P6 + "informationen_komplett": f"CASE {k} % 6 WHEN 0 THEN 'ja' WHEN 1 THEN 'ja' WHEN 2 THEN 'teils' WHEN 3 THEN 'nein' END",
        P6 + "info_aenderung": f"CASE {cu} % 5 WHEN 0 THEN 'anders' WHEN 4 THEN NULL ELSE 'gleich' END",
        P6 + "info_wunsch": ticks(("mail", f"{k} % 40 = 0"), ("chat", f"{cu} % 25 = 0")),
        P6 + "weiterempfehlung": f"CASE WHEN {k} % 12 <> 0 THEN {s(f'({k} + {cu}) % 11')} END",
        "block_demografie/gender": f"CASE {k} % 5 WHEN 0 THEN 'w' WHEN 1 THEN 'w' WHEN 2 THEN 'm' WHEN 3 THEN 'd' END",
        "block_demografie/jahre": f"CASE WHEN {k} % 41 = 0 THEN '120' WHEN {k} % 43 = 0 THEN 'x' "
                                  f"ELSE {s(f'12 + ({k} * 3 + {cu}) % 20')} END",
        "block_demografie/schultyp": f"CASE {cu} % 3 WHEN 0 THEN 'gym' WHEN 1 THEN 'real' END",
        "block_demografie/kontakt": ticks(
            ("ja_gemeinde", f"{k} % 4 = 0"), ("ja_andere", f"{k} % 6 = 0"), ("nein", f"{k} % 4 = 1"), ("weiss_nicht", f"{k} % 10 = 9")),
        "block_demografie/kontakt_sonst": f"CASE WHEN {k} % 12 = 0 THEN concat('Ort ', {s(f'{cu} % 4')}) END",
    }
    for i, (name, top) in enumerate((("eig_gemeinschaft", 6), ("eig_offen_religionen", 6), ("eig_ausprobieren", 5))):
        out[P2 + name] = f"CASE WHEN ({k} + {i}) % 11 <> 0 THEN {s(f'1 + ({k} * 7 + {cu} + {i}) % {top}')} END"
    for i, name in enumerate(("kreativ", "lernen", "glaube_spiritualitaet", "transfer")):
        out[P3 + name] = f"CASE WHEN ({k} + {cu} + {i}) % 9 <> 0 THEN {s(f'1 + ({k} * {i + 2} + {cu}) % 6')} END"
    return out


def group_answers() -> dict[str, str]:
    k = "c_custkey"
    g = s(f"CAST(floor({k} / 14) AS BIGINT)")
    out = {
        A + "F1_Wochentage": ticks(("montag", f"{k} % 2 = 0"), ("dienstag", f"{k} % 3 = 0"), ("freitag", f"{k} % 5 < 3")),
        A + "Montag_Stunden": f"CASE WHEN {k} % 4 = 0 THEN concat({s(f'1 + {k} % 3')}, '.5') WHEN {k} % 10 = 2 THEN 'zwei' END",
        A + "dienstag_stunden": f"CASE WHEN {k} % 3 = 0 THEN {s(f'{k} % 4')} END",
        A + "F2_Anzahl_Auftritte": f"CASE WHEN {k} % 9 <> 0 THEN {s(f'{k} % 8')} END",
        A + "angebote_vor_ort": ticks(("chor", f"{k} % 2 = 0"), ("theater", f"{k} % 5 = 0"), ("alt", f"{k} % 17 = 0")),
        A + "F4_Hauptamt": f"CASE {k} % 3 WHEN 0 THEN 'ja_voll' WHEN 1 THEN 'nein' END",
        A + "Hauptamt_Wochenstunden": f"CASE WHEN {k} % 3 = 0 THEN concat({s(f'{k} % 40')}, '.5') END",
        "block_aktive/Mitarbeitende_inkl_Leitung": f"CASE WHEN {k} % 50 <> 3 THEN {s(f'1 + {k} % 6')} END",
        "block_aktive/Teilnehmende": f"CASE WHEN {k} % 60 <> 5 THEN {s(f'5 + {k} % 30')} END",
        B + "tngewinnung_probleme": f"CASE {k} % 4 WHEN 0 THEN 'nein' WHEN 1 THEN 'phase' WHEN 2 THEN 'gross' END",
        B + "tngewinnung_massnahmen": ticks(
            ("flyer", f"{k} % 2 = 1"), ("social_media", f"{k} % 3 = 0"), ("sonstige", f"{k} % 4 = 0")),
        B + "tngewinnung_massnahmen_sonst": f"CASE WHEN {k} % 8 = 0 OR {k} % 7 = 0 THEN concat('idee ', {s(f'{k} % 6')}) END",
        E + "insgesamt": f"CASE WHEN {k} % 10 <> 0 THEN {s(f'1 + {k} % 6')} END",
        E + "flyer": f"CASE WHEN {k} % 2 = 1 THEN {s(f'1 + {k} % 5')} END",
        E + "social_media": f"CASE WHEN {k} % 3 = 0 THEN {s(f'1 + {k} % 4')} END",
        E + "sonstige": f"CASE WHEN {k} % 4 = 0 THEN {s(f'1 + {k} % 3')} END",
        "weitereUnterstuetzung": f"CASE WHEN {k} % 6 = 0 THEN concat('mehr ', {s('c_nationkey')}) END",
        W + "region": f"CASE {k} % 5 WHEN 0 THEN 'nord' WHEN 1 THEN 'sued' WHEN 2 THEN 'ost' WHEN 3 THEN 'owl' END",
        W + "ortsgruppe_name": f"CASE WHEN {k} % 11 = 0 THEN '' WHEN {k} % 13 = 0 THEN NULL "
                               f"WHEN {k} % 17 = 0 THEN concat('Grp ', {g}) WHEN {k} % 2 = 0 THEN concat('Gruppe ', {g}) ELSE concat('gruppe ', {g}) END",
    }
    need = ["nein", "eher_nein", "eher_ja", "ja", "unsicher"]
    for i, name in enumerate(("technik", "geld", "werbung")):
        cases = " ".join(f"WHEN {j} THEN '{code}'" for j, code in enumerate(need))
        out[S + name] = f"CASE ({k} + {i} * 2) % {6 + i} {cases} END"
    for i, (code, _) in enumerate(CHOICES["m_gender"]):
        for j, who in enumerate(("mitarbeitende", "teilnehmende")):
            out[f"{D}block_gender_{code}_{who}"] = (
                f"CASE WHEN {k} % 701 = 0 THEN 'x' WHEN ({k} + {i}) % 4 <> 0 THEN {s(f'({k} + {i + j}) % 7')} END"
            )
    for i, (code, _) in enumerate(CHOICES["m_age"]):
        for j, who in enumerate(("mitarbeitende", "teilnehmende")):
            value = s(f"({k} + {i * 2 + j}) % 9")
            out[f"{D}group_jahre_{code}_{who}"] = (
                f"CASE WHEN {k} % 97 = 0 THEN 'x' WHEN ({k} + {j}) % 3 <> 0 THEN {value} END"
            )
    # a customer now and then sends an empty form
    return {path: f"CASE WHEN {k} % 29 <> 0 THEN {e} END" for path, e in out.items()}


PERSON_BASE = {
    "_id": "o_orderkey", "_uuid": "o_orderpriority",
    "year": "CAST(year(o_orderdate) AS INT)",
    "end": "o_orderdate + (o_orderkey % 90) * INTERVAL '1' DAY",
}
GROUP_BASE = {
    "_id": "c_custkey", "meta/instance": "c_name", "formhub/uuid": "c_name", "start": "c_name",
    "year": "CAST(1995 + c_custkey % 7 AS INT)",
    "end": "CAST(make_date(CAST(1995 + c_custkey % 7 AS INT), 10, 1) AS TIMESTAMP) + (c_custkey % 120) * INTERVAL '1' DAY",
}


def person_submissions(spark: SparkSession, sf: str) -> DataFrame:
    exprs = {**PERSON_BASE, **person_answers()}
    return table(spark, sf, "orders").select(*[F.expr(e).alias(p) for p, e in exprs.items()])


def group_submissions(spark: SparkSession, sf: str) -> DataFrame:
    exprs = {**GROUP_BASE, **group_answers()}
    return table(spark, sf, "customer").select(*[F.expr(e).alias(p) for p, e in exprs.items()])


GROUP_REGION = ("CASE g % 7 WHEN 0 THEN 'Nord' WHEN 1 THEN 'Süden' WHEN 2 THEN 'Ostwerk' WHEN 3 THEN 'Hessen' "
                "WHEN 4 THEN 'Ostwestfalen-Lippe' WHEN 5 THEN 'Anhalt' END")


def spelling_map(spark: SparkSession, sf: str) -> DataFrame:
    """Two spellings per known group, and one entry for a missing name."""
    g = table(spark, sf, "customer").select(F.expr("CAST(floor(c_custkey / 14) AS BIGINT)").alias("g")).distinct()
    known = g.select(
        F.explode(F.array(F.concat(F.lit("Gruppe "), "g"), F.concat(F.lit("gruppe "), "g"))).alias("og_name_orig"),
        F.concat(F.lit("Gruppe "), "g").alias("og_name"),
        F.expr(GROUP_REGION).alias("og_region"),
    )
    missing = local_table(spark, [(None, None, None)], "og_name_orig string, og_name string, og_region string")
    return known.unionByName(missing)


def region_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, REGIONS, "og_region string, region_grouped string, slug string")


def metadata(spark: SparkSession, which: str) -> DataFrame:
    return local_table(spark, GROUP_FORM if which == "og" else PERSON_FORM, META_SCHEMA)


def choice_table(spark: SparkSession) -> DataFrame:
    rows = [(name, label, listed, i) for listed, pairs in CHOICES.items() for i, (name, label) in enumerate(pairs)]
    return local_table(spark, rows, "name string, label string, list_name string, ord int")


_FORMS: dict[tuple[str, str], Form] = {}


def form(spark: SparkSession, which: str) -> Form:
    """The group form (og) or the person form (tn), searched once per application."""
    key = (spark.sparkContext.applicationId, which)
    if key not in _FORMS:
        meta = metadata(spark, which)
        specs = c.GROUP_QUESTIONS if which == "og" else c.eigenschaften_by_block(meta, c.PERSON_QUESTIONS)
        _FORMS[key] = load_form(meta, choice_table(spark), specs)
    return _FORMS[key]
