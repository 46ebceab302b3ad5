"""License scan: ordered signature rules behind a keyword filter. DataFrame functions only.

A text becomes its lower-cased words with one blank between them. Of some three hundred
patterns only those run whose keyword is among the words (one intersection with the list
of keywords), and only those that match are located: their matches are marked in the text
and the marks counted off in words. Detections are sorted by start, longest first, then by
level and order; one pass keeps the farthest end of each level and drops what lies inside
a detection of its own or a higher level. Base phrases are always kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import ascii_lower
from meshtally.llm.license_signatures import BASE, signatures

WEIGHTS = (0.95, 0.8, 0.5, 0.2)  # of a detection, by level
CHUNK = 512  # detections that one inner pass collects
OPEN, CLOSE = "\x01", "\x02"  # marks; no word holds them
DETECTION = "struct<start:int,back:int,level:int,nr:int,label:string,base:boolean>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def spaced_words(text: Column) -> Column:
    """The words with one blank between them and at both ends; null is empty."""
    words = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def rules_by_keyword(rules: list[tuple[int, str, str, str]], base: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The keywords as an array, and a map from keyword to its rules."""
    held = defaultdict(list)
    for nr, (level, label, keyword, pattern) in enumerate(rules):
        held[keyword].append((level, nr, label, False, pattern))
    for nr, (label, keyword, phrase) in enumerate(base, len(rules)):
        held[keyword].append((2, nr, label, True, phrase))
    fields = ("level", "nr", "label", "base", "pattern")
    of = [F.array(*(F.struct(*(F.lit(v).alias(f) for f, v in zip(fields, (*r[:4], f"(?<= )(?:{r[4]})(?= )")))) for r in rs))
          for rs in held.values()]
    return F.array(*map(F.lit, held)), F.map_from_arrays(F.array(*map(F.lit, held)), F.array(*of))


def marks(marked: Column, mark: Column, at_end: bool) -> Column:
    """Word numbers, from 0, of the words that carry a mark."""
    has = F.endswith if at_end else F.startswith
    return F.array_compact(F.transform(F.split(marked, " "), lambda w, i: F.when(has(w, mark), i)))


def located(spaced: Column, rule: Column) -> Column:
    """Detections of one rule."""
    marked = F.trim(F.regexp_replace(spaced, rule.pattern, F.lit(f"{OPEN}$0{CLOSE}")))
    return let(marked, lambda m: F.zip_with(
        marks(m, F.lit(OPEN), False), marks(m, F.lit(CLOSE), True),
        lambda a, b: F.struct(a.alias("start"), (-b).alias("back"), rule.level.alias("level"), rule.nr.alias("nr"),
                              rule.label.alias("label"), rule.base.alias("base"))))


def unsuppressed(ordered: Column) -> Column:
    """The sorted detections without those inside an earlier one of their own or a higher level.

    State: the farthest end of each level. Results are collected by chunks, so that a text
    with very many detections isn't copied once for each.
    """
    none = F.array().cast(f"array<{DETECTION}>")

    def add(acc: Column, d: Column) -> Column:
        inside = F.exists(F.slice(acc.reach, 1, d.level + 1), lambda end: end >= -d.back)
        reach = F.when(d.base, acc.reach).otherwise(
            F.transform(acc.reach, lambda end, k: F.when((k == d.level) & (end < -d.back), -d.back).otherwise(end)))
        kept = F.when(d.base | ~inside, F.concat(acc.kept, F.array(d))).otherwise(acc.kept)
        return F.struct(reach.alias("reach"), kept.alias("kept"))

    def chunk(acc: Column, part: Column) -> Column:
        found = F.aggregate(part, F.struct(acc.reach.alias("reach"), none.alias("kept")), add)
        return let(found, lambda f: F.struct(f.reach.alias("reach"), F.concat(acc.kept, F.array(f.kept)).alias("kept")))

    def run(every: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / CHUNK).cast("int")),
                            lambda k: F.slice(every, k * CHUNK + 1, CHUNK))
        start = F.struct(F.array(*[F.lit(-1)] * len(WEIGHTS)).alias("reach"),
                         F.array().cast(f"array<array<{DETECTION}>>").alias("kept"))
        return F.when(F.size(every) == 0, none).otherwise(F.flatten(F.aggregate(parts, start, chunk).kept))

    return let(ordered, run)


def detections(text: Column, rules: list[tuple[int, str, str, str]] | None = None,
               base: list[tuple[str, str, str]] | None = None) -> Column:
    """struct: n_words, and found, the kept detections: first and last word, level, label, base.

    rules: (level 0 to 3, label, keyword, pattern over words), base: (label, keyword, phrase);
    every match must hold its rule's keyword as a word. A null text is empty and has neither.
    Repeated places of a phrase are all found; a text of any length is scanned whole.
    """
    keywords, of = rules_by_keyword(signatures() if rules is None else rules, BASE if base is None else base)

    def run(spaced: Column) -> Column:
        present = F.array_intersect(F.split(F.trim(spaced), " "), keywords)
        near = F.flatten(F.transform(present, lambda k: F.element_at(of, k)))
        hits = F.flatten(F.transform(F.filter(near, lambda r: F.rlike(spaced, r.pattern)), lambda r: located(spaced, r)))
        found = F.transform(unsuppressed(F.array_sort(hits)), lambda d: F.struct(
            d.start.alias("first"), (-d.back).alias("last"), d.level.alias("level"), d.label.alias("label"), d.base.alias("base")))
        blanks = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
        return F.struct(F.when(F.trim(spaced) == "", 0).otherwise(blanks - 1).cast("bigint").alias("n_words"), found.alias("found"))

    return let(spaced_words(text), run)


def scan(docs: DataFrame, text: str = "text", into: str = "_licenses", rules: list[tuple[int, str, str, str]] | None = None,
         base: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """docs with a struct column `into`: n_words and the detections of each text.

    All other columns stay as they are, but for one named like `into`. Rows are independent:
    repeated rows and null ids are scanned like others, an empty table gives an empty one.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*names, detections(F.col(f"`{text}`"), rules, base).alias(into))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of each row.

    score: the weight of the surest detection, 0 without any.
    """
    rows = scan(docs.select("doc_id", "text")).select("doc_id", "_licenses.n_words", "_licenses.found")
    rows = rows.withColumn("of_base", F.filter("found", lambda d: d.base))
    weight = F.array(*map(F.lit, WEIGHTS))

    def named(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d.label))), ",")

    starts = F.transform("of_base", lambda d: d.first)
    return rows.select(
        "doc_id", "n_words", F.size("of_base").cast("bigint").alias("n_base"), F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"), named(F.col("of_base")).alias("base_labels"),
        named(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda d: F.get(weight, d.level))), F.lit(0.0)).alias("score"))
