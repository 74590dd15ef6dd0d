"""Line-first cleaning: rules for single lines, then a verdict on documents that lose too much text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: A line fails if more than this share of its characters that aren't spaces is punctuation or symbols.
PUNCTUATION_PERCENT = 25
#: A line of this many separators or more, or a short line that is a link's usual label, is navigation.
SEPARATORS = 2
SEPARATOR_CLASS = r"[|»›•→]"
#: In English, German, French and Spanish; letters beyond ASCII in both cases, as patterns fold ASCII alone.
NAVIGATION = "(?i)^(" + "|".join([
    "home|menu|log ?in|sign (in|up)|search|next|previous|back|contact( us)?|about( us)?|share( this)?|subscribe|read more|site ?map|skip to (main )?content|back to top",
    "startseite|men[uüÜ]|anmelden|abmelden|registrieren|suche|weiter|zur[üÜ]ck|kontakt|[üÜ]ber uns|teilen|abonnieren|mehr lesen|weiterlesen|nach oben|zum inhalt( springen)?",
    "accueil|connexion|s.inscrire|rechercher|suivant|pr[éÉ]c[éÉ]dent|retour|nous contacter|[àÀ] propos|partager|s.abonner|lire la suite|plan du site|haut de page|aller au contenu",
    "inicio|men[uúÚ]|iniciar sesi[óÓ]n|registrarse|buscar|siguiente|anterior|volver|contacto|acerca de|compartir|suscribirse|leer m[áÁ]s|mapa del sitio|ir al contenido",
]) + ")[ .!:]*$"
BOILERPLATE = "(?i)(" + "|".join([
    r"all rights reserved|lorem ipsum|javascript|cookie|privacy policy|terms of (use|service)|licensed under|released under the|copyright (©|\(c\))",
    "alle rechte vorbehalten|datenschutzerkl[äÄ]rung|nutzungsbedingungen|impressum",
    "tous droits r[éÉ]serv[éÉ]s|politique de confidentialit[éÉ]|conditions d.utilisation|mentions l[éÉ]gales",
    "todos los derechos reservados|pol[íÍ]tica de privacidad|t[éÉ]rminos de (uso|servicio)|aviso legal",
]) + ")"
#: Lower-case stems of which each boilerplate phrase holds one: texts without any of them need no pattern.
STEMS = ("rights reserved", "lorem ipsum", "javascript", "cookie", "privacy policy", "terms of ", "licensed under", "released under", "copyright (", "copyright ©", "rechte vorbehalten", "datenschutzerkl", "nutzungsbedingungen", "impressum", "tous droits r", "politique de confidentialit", "conditions d", "mentions l", "derechos reservados", "tica de privacidad", "rminos de ", "aviso legal")
#: A document goes if its lines lose more than this share of its characters that aren't spaces.
LOST_PERCENT = 50
MIN_WORDS = 50
REPEAT_PERCENT = 50


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != "")


def unspaced(text: Column) -> Column:
    """Characters of the text that aren't spaces."""
    return F.length(F.translate(text, " \t\n\x0b\f\r", ""))


def may_hold_boilerplate(text: Column) -> Column:
    """False only for texts in which no boilerplate phrase can stand."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [low.contains(stem) for stem in STEMS])


def line_fails(line: Column, suspect: Column) -> Column:
    """True for a line of words that the punctuation, navigation or boilerplate rules reject; lines without words pass.

    :param suspect: whether the line's text may hold boilerplate.
    """
    marks = F.length(F.regexp_replace(line, r"[^\p{P}\p{S}]+", ""))
    separators = F.length(F.regexp_replace(line, SEPARATOR_CLASS.replace("[", "[^") + "+", ""))
    return (marks * 100 > unspaced(line) * PUNCTUATION_PERCENT) | (separators >= SEPARATORS) | F.trim(line).rlike(NAVIGATION) | (suspect & line.rlike(BOILERPLATE))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def with_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add to each row its cleaned text, the figures of the base rules and the verdict.

    Adds clean_text (the lines that pass, in their order; null for null), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed and kept (boolean). Columns of these names that the input has are replaced.
    Null, empty and wordless texts have no words and fail; very long texts are read whole. Repeated rows each get their
    row; an empty table gives an empty table.

    All of it is column expressions within the row: nothing is shuffled. Sorting windows is left to texts in which a
    window does occur twice. Windows are told apart by 64 bits of their hash within a text.
    """
    own = "__w __lines __h __s __at __suspect".split()
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumns({"__w": words_of(F.col(text_col)), "__lines": F.split(text, "\n"), "__suspect": may_hold_boilerplate(text)})
    windows = F.transform(F.sequence(F.lit(0), F.size("__w") - 3), lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    out = out.withColumn("__h", F.when(F.size("__w") >= 3, windows).otherwise(F.array().cast("array<long>")))
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    pairs = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__s", F.when(repeats, pairs))

    def twice(j: Column) -> Column:
        h = F.get("__s", j)["h"]
        return F.coalesce(h == F.get("__s", j + 1)["h"], F.lit(False)) | F.coalesce((j > 0) & (h == F.get("__s", j - 1)["h"]), F.lit(False))

    places = F.transform(F.filter(F.sequence(F.lit(0), F.size("__s") - 1), twice), lambda j: F.get("__s", j)["i"])
    out = out.withColumn("__at", F.when(F.col("__s").isNotNull(), F.sort_array(places)).otherwise(F.array().cast("array<int>")))
    lines = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    covered = F.transform("__at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("__at", j + 1) - p, F.lit(3))).cast("long"))
    clean = F.array_join(F.filter("__lines", lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & line_fails(x, F.col("__suspect")))), "\n")
    out = out.withColumns(
        {
            "clean_text": F.when(F.col(text_col).isNotNull(), clean),
            "n_words": F.size("__w").cast("long"),
            "word_chars": unspaced(text).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _total(covered),
        }
    )
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT))
    left = F.coalesce(unspaced(F.col("clean_text")), F.lit(0))
    return out.withColumn("kept", ~F.col("base_failed") & (left * 100 >= F.col("word_chars") * (100 - LOST_PERCENT))).drop(*own)


#: The patterns mean the same in both engines' expressions, so the SQL takes them as they are.
ORACLE_SQL = f"""
with w as (
  select doc_id, coalesce(text, '') as t, text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') as w
  from documents),
win as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)),
rep as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as p
        from (select doc_id, i, count(*) over (partition by doc_id, s) as c from win) where c > 1)
  group by doc_id),
lines as (
  select doc_id, unnest(string_split(t, chr(10))) as line from w),
judged as (
  select doc_id, line, length(regexp_replace(line, '[ \\t\\n\\x0b\\f\\r]', '', 'g')) as solid,
         length(regexp_replace(line, '[^\\p{{P}}\\p{{S}}]', '', 'g')) as marks,
         length(regexp_replace(line, '{SEPARATOR_CLASS.replace("[", "[^")}', '', 'g')) as seps
  from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
per as (
  select doc_id, count(*) - count(distinct line) as n_dup,
         sum(case when marks * 100 > solid * {PUNCTUATION_PERCENT} or seps >= {SEPARATORS}
                    or regexp_matches(trim(line), '{NAVIGATION}') or regexp_matches(line, '{BOILERPLATE}')
                  then 0 else solid end) as left_chars
  from judged group by doc_id),
base as (
  select w.doc_id, cast(len(w.w) as bigint) as n_words,
         cast(list_sum(list_transform(w.w, lambda x: length(x))) as bigint) as wc,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(per.n_dup, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
         coalesce(per.left_chars, 0) as left_chars
  from w left join per on w.doc_id = per.doc_id left join rep on w.doc_id = rep.doc_id)
select doc_id, n_words, coalesce(wc, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) as base_failed,
       (not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
        and left_chars * 100 >= coalesce(wc, 0) * {100 - LOST_PERCENT}) as kept
from base
"""
