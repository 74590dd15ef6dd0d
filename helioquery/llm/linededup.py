"""Line dedup across a corpus: deletion neighbourhoods joined on hashed keys, verified, the earliest line kept.

Lines that differ by one edit have a common variant: a substitution leaves equal rests when its place is deleted from
both, an insertion leaves the shorter line when its place is deleted from the longer. All variants of all lines would
be as many as characters, so two exact rounds prune first: one edit leaves all of a line but one segment untouched, so
a line whose masked copies meet no other line has no neighbour, and only the segments that do meet one are varied.

Until then lines are hashes: texts are read where they lie, and only those of lines that may have a neighbour move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, narrow_join

#: Segments of the second round; the first one, which all lines pass, has two.
FINE = 16


def normal(line: Column) -> Column:
    """Lines are compared in lower case, with runs of ASCII white space as one space and none at the ends."""
    odd = line.contains("  ")
    for c in "\t\x0b\f\r":
        odd = odd | line.contains(c)
    return F.trim(F.lower(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line)))


def _masked(lines: DataFrame, segments: int, *keep: str) -> DataFrame:
    """Each line's masked copies as keys: for both shorter lengths that a partner may give the pair, without segment j."""
    length, shorter = F.length("line"), F.col("__c")
    out = lines.withColumn("__c", F.explode(F.array(length, length - 1))).where("__c >= 0")
    out = out.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
    begin, end = (F.floor(j * shorter / segments).cast("int") for j in (F.col("__j"), F.col("__j") + 1))
    key = F.xxhash64(shorter, "__j", F.substring("line", F.lit(1), begin), F.substring("line", length - (shorter - end) + 1, length))
    return out.select(*keep, key.alias("key"), begin.alias("begin"), (length - (shorter - end)).alias("end"))


def _met(keyed: DataFrame) -> DataFrame:
    """The keys under which two different lines meet."""
    return keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("key")


def half_keys(line: Column) -> list[Column]:
    """Keys of the first round: for both shorter lengths that a partner may give the pair, one half alone."""
    length, out = F.length(line), []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        out += [F.xxhash64(shorter, F.lit(0), F.substring(line, length - (shorter - half) + 1, length)), F.xxhash64(shorter, F.lit(1), F.substring(line, F.lit(1), half))]
    return out


def earlier_neighbours(near: DataFrame) -> DataFrame:
    """(first) of those lines that have one within one edit whose first place is earlier.

    :param near: (line, first: an orderable place) of distinct lines.
    """
    near = near.withColumn("h", F.xxhash64("first", "line"))
    keyed = _masked(near, FINE, "h")
    parts = narrow_join(keyed, durable(_met(keyed)), "key", "left_semi")
    # variants without one character of the segments that meet; beside them the lines as they are, which a longer line's variant can equal
    place = parts.where("end > begin").select("h", F.explode(F.sequence(F.col("begin") + 1, F.col("end"))).alias("at")).distinct()
    rest = F.concat(F.substring("line", F.lit(1), F.col("at") - 1), F.substring("line", F.col("at") + 1, F.length("line")))
    varied = durable(place.join(near, "h").select("h", "first", F.xxhash64(rest).alias("k1"), F.hash(rest).alias("k2"), "at"))
    plain = near.select("h", "first", F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"), F.lit(0).alias("at"))
    both = varied.union(plain)
    # equal rests of one place: a substitution; the earliest line of each group stands for it, so no pairs are made
    swapped = varied.groupBy("k1", "k2", "at").agg(F.min("first").alias("other"))
    a = varied.join(swapped, ["k1", "k2", "at"]).where("other < first").select("h", "other")
    grouped = both.groupBy("k1", "k2").agg(F.min(F.when(F.col("at") == 0, F.col("first"))).alias("full"), F.min(F.when(F.col("at") > 0, F.col("first"))).alias("cut"))
    met_here = both.join(grouped.where("full is not null and cut is not null"), ["k1", "k2"])
    b = met_here.select("h", "first", F.when(F.col("at") == 0, F.col("cut")).otherwise(F.col("full")).alias("other")).where("other < first").select("h", "other")
    claims = a.union(b).distinct()
    texts = near.select("h", "line", "first")
    others = near.select(F.col("first").alias("other"), F.col("line").alias("other_line"))
    close = F.levenshtein(F.col("line"), F.col("other_line"), 1)
    verified = claims.join(texts, "h").join(others, "other").where((close >= 0) & (close <= 1))
    return verified.select("first").distinct()


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, line_no) of every line that stays: the first of equal lines, unless a near line stands earlier still.

    Lines are told apart by 96 bits of hash.
    """
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "raw"))
    lines = split.select(F.struct("id", "mark", "line_no").alias("place"), normal(F.col("raw")).alias("line")).where("line <> ''")
    lines = lines.select("place", "line", F.xxhash64("line").alias("h"), F.hash("line").alias("h2"))
    keys = [k.alias(f"k{n}") for n, k in enumerate(half_keys(F.col("line")))]
    hashed = lines.select("place", "h", "h2", *keys).groupBy("h", "h2").agg(F.min("place").alias("first"), *(F.first(f"k{n}").alias(f"k{n}") for n in range(len(keys))))
    firsts = durable(hashed)
    keyed = firsts.select("h", F.explode(F.array(*(f"k{n}" for n in range(len(keys))))).alias("key"))
    suspects = durable(narrow_join(keyed, durable(_met(keyed)), "key", "left_semi").select("h").distinct())
    places = durable(narrow_join(firsts, suspects, "h", "left_semi").select("first", F.col("first.mark").alias("mark")))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    found = narrow_join(texts, places, "mark", "inner").where(F.col("id").eqNullSafe(F.col("first.id")))
    near = durable(found.select("first", normal(F.get(F.split("text", "\n"), F.col("first.line_no"))).alias("line")).distinct())
    gone = durable(earlier_neighbours(near))
    return narrow_join(firsts, gone, "first", "left_anti").select("first.id", "first.mark", "first.line_no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove from every document the lines that occur earlier in the corpus, equal or within one edit.

    Earlier means a smaller (id, hash of the text, line number); lines are compared in their normal form and one edit is a character
    inserted, deleted or changed. A line that goes still stands for later ones. Lines without words stay. All columns of
    the input stay; ``text_col`` is what remains, and n_lines and n_kept (int) are added, replacing columns so named.

    Null texts stay null with no line. A text whose lines all go is empty. A document is an id and a text: of rows that
    share an id, or have none, those of different texts are documents of their own, in the order of the texts' hashes;
    equal ones lose or keep the same lines. Rows without id come first. An empty table gives an empty table.

    Two shuffles carry text: of lines that may have a neighbour, and of documents when they meet the numbers of the lines
    that stay. All others carry hashes and places. Few keys are broadcast, their number checked; many are joined by a shuffle.
    """
    kept = kept_lines(docs, id_col, text_col).groupBy("id", "mark").agg(F.collect_list("line_no").alias("__kept"))
    kept = kept.withColumnsRenamed({"id": "__id", "mark": "__mark"})
    out = docs.withColumn("__own", F.xxhash64(text_col))
    out = out.join(kept, out[id_col].eqNullSafe(kept["__id"]) & (out["__own"] == kept["__mark"]), "left").drop("__id", "__own", "__mark")
    out = out.withColumn("__lines", F.split(text_col, "\n"))
    blank = F.filter(F.transform("__lines", lambda x, i: F.when(~x.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())
    inside = F.filter(F.coalesce("__kept", F.array().cast("array<int>")), lambda i: i < F.size("__lines"))
    out = out.withColumn("__at", F.sort_array(F.array_union(inside, blank)))
    text = F.array_join(F.transform("__at", lambda i: F.get("__lines", i)), "\n")
    counted = {"n_lines": F.coalesce(F.when(F.col("__lines").isNotNull(), F.size("__lines")), F.lit(0)), "n_kept": F.coalesce(F.when(F.col("__lines").isNotNull(), F.size("__at")), F.lit(0))}
    return out.withColumns({text_col: F.when(F.col("__lines").isNotNull(), text), **counted}).drop("__kept", "__lines", "__at")


ORACLE_SQL = r"""
with l as (
  select doc_id, unnest(range(0, len(s))) as line_no, unnest(s) as raw
  from (select doc_id, string_split(text, chr(10)) as s from documents where text is not null)),
n as (
  select doc_id, line_no, raw, trim(lower(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g'))) as line from l),
f as (
  select line, min({'d': doc_id, 'n': line_no}) as first, length(line) as len from n where line <> '' group by line),
side as (
  select line, first, len, c, unnest(['L' || left(line, c // 2), 'R' || right(line, c - c // 2)]) as k
  from (select line, first, len, unnest([len, len - 1]) as c from f) where c >= 0),
pair as (
  select distinct case when a.len <= b.len then a.line else b.line end as s, case when a.len <= b.len then b.line else a.line end as t,
         greatest(a.first, b.first) as later
  from side a join side b on a.c = b.c and a.k = b.k and a.first < b.first and abs(a.len - b.len) <= 1),
apart as (
  select s, t, later, coalesce(list_min(list_filter(range(1, length(s) + 1), lambda i: x[i] <> y[i])), length(s) + 1) as i
  from (select s, t, later, string_split(s, '') as x, string_split(t, '') as y from pair)),
gone as (
  select distinct later as first from apart
  where substr(s, case when length(s) = length(t) then i + 1 else i end) = substr(t, i + 1)),
k as (
  select first.d as doc_id, first.n as line_no from f where first not in (select first from gone)),
o as (
  select n.doc_id, n.line_no, n.raw, (n.line = '' or k.doc_id is not null) as kept
  from n left join k on n.doc_id = k.doc_id and n.line_no = k.line_no)
select d.doc_id, cast(coalesce(count(o.line_no), 0) as int) as n_lines, cast(coalesce(sum(cast(o.kept as int)), 0) as int) as n_kept,
       md5(case when d.text is not null then coalesce(string_agg(o.raw, chr(10) order by o.line_no) filter (where o.kept), '') end) as text_md5
from documents d left join o on d.doc_id = o.doc_id group by d.doc_id, d.text
"""
