"""Licence scans by ordered signature rules (operator 10); DataFrame expressions only, one pass, no shuffle.

A text is reduced to its words, A-Z lower-cased, joined by single spaces. Hundreds of regular expressions
(``license_rules.RULES``) are gated twice: a text without any of a few general words is done, and of the rest each
rule only runs where the text holds its keyword. Matches carry their interval. A match that lies within the
interval of a match of higher priority is suppressed: all matches, sorted by start, falling end and priority, are
passed once, with the furthest end seen at each priority.

The base phrases are counted apart, at all places, also overlapping ones, and their labels always stay.

Lower-casing is Unicode's, which is the same for these purposes: no character outside of A-Z turns into an ASCII
letter that a base phrase contains, and none turns into a separator.

Defined cases: a null text is empty, with no words, empty labels and score 0. Rows are scanned one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.license_rules import GATES, RULES

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
OPEN, CLOSE = "\x01", "\x02"  # can't occur among words
LEVELS = (1, 2, 3, 4)


def _places(words: Column, text: Column, phrase: str) -> Column:
    """Starts of the phrase, counted in words."""
    own = phrase.split(" ")

    def here(i: Column) -> Column:
        found = F.get(words, i.cast("int")) == own[0]
        for k, word in enumerate(own[1:], 1):
            found = found & (F.get(words, (i + k).cast("int")) == word)
        return found

    last = F.size(words) - len(own)
    starts = F.filter(F.sequence(F.lit(0).cast("long"), last.cast("long")), here)
    return F.when(text.contains(f" {phrase} "), starts).otherwise(F.array().cast("array<bigint>"))


def _rules() -> Column:
    quote = "'"
    rows = ", ".join(
        f"({r.priority}, '{r.label}', '{r.keyword}', r'(?<= )({r.pattern.replace(quote, '')})(?= )', {r.weight}D)" for r in RULES)
    return F.expr(f"transform(array({rows}), r -> named_struct('priority', r.col1, 'label', r.col2, 'keyword', r.col3, 'pattern', r.col4, 'weight', r.col5))")


def _matches(text: Column, rule: Column) -> Column:
    """Intervals of a rule in the text: marks are set around matches, and the parts between marks give the places."""
    parts = F.split(F.regexp_replace(text, rule["pattern"], F.lit(f"{OPEN}$0{CLOSE}")), f"[{OPEN}{CLOSE}]", -1)
    kind = "struct<at:int,inside:boolean,found:array<struct<start:int,end:int>>>"
    begin = F.from_json(F.lit('{"at": 0, "inside": false, "found": []}'), kind)

    def walk(s: Column, part: Column) -> Column:
        end = s["at"] + F.length(part)
        own = F.array(F.struct(s["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), (~s["inside"]).alias("inside"),
                        F.when(s["inside"], F.concat(s["found"], own)).otherwise(s["found"]).alias("found"))

    found = F.aggregate(parts, begin, walk, lambda s: s["found"])
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), (-m["end"]).alias("minus_end"), rule["priority"].alias("priority"),
        rule["label"].alias("label"), rule["weight"].alias("weight")))


def _kept(matches: Column) -> Column:
    """Labels and the greatest weight of matches that no match of higher priority contains."""
    kind = f"struct<{','.join(f'end{p}:int' for p in LEVELS)},labels:array<string>,score:double>"
    begin = F.from_json(F.lit("{" + ", ".join(f'"end{p}": -1' for p in LEVELS) + ', "labels": [], "score": 0.0}'), kind)

    def walk(s: Column, m: Column) -> Column:
        end = -m["minus_end"]
        above = F.lit(False)
        for p in LEVELS:
            above = above | ((m["priority"] > p) & (s[f"end{p}"] >= end))
        ends = [F.when(m["priority"] == p, F.greatest(s[f"end{p}"], end)).otherwise(s[f"end{p}"]).alias(f"end{p}") for p in LEVELS]
        return F.struct(*ends, F.when(above, s["labels"]).otherwise(F.array_union(s["labels"], F.array(m["label"]))).alias("labels"),
                        F.when(above, s["score"]).otherwise(F.greatest(s["score"], m["weight"])).alias("score"))

    return F.aggregate(F.array_sort(matches), begin, walk, lambda s: F.struct(s["labels"].alias("labels"), s["score"].alias("score")))


def scan(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` (id, text): n_words, starts of the base phrases, base_labels, matches, labels, score."""
    split = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), SEPARATORS, -1), "")
    words = docs.select(F.col(id_column), split.alias("words"))
    texts = words.select(F.col(id_column), "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.col("joined").contains(word)
    hit_rules = F.filter(_rules(), lambda r: F.contains(F.col("joined"), r["keyword"]))
    none = F.array().cast("array<struct<start:int,minus_end:int,priority:int,label:string,weight:double>>")
    matches = F.when(gate, F.flatten(F.transform(hit_rules, lambda r: _matches(F.col("joined"), r)))).otherwise(none)
    places = [_places(F.col("words"), F.col("joined"), phrase).alias(f"base{k}") for k, (phrase, _) in enumerate(BASE)]
    found = texts.select(F.col(id_column), F.size("words").cast("long").alias("n_words"), matches.alias("matches"), *places)
    kept = _kept(F.col("matches"))
    no_labels = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    scored = found.select(
        F.col(id_column), "n_words", "matches", F.concat(*[f"base{k}" for k in range(len(BASE))]).alias("places"),
        F.array_sort(base_labels).alias("base"), F.when(F.size("matches") > 0, kept).otherwise(no_labels).alias("kept"))
    return scored.select(
        F.col(id_column), "n_words", "places", "base", F.array_sort(F.array_union("base", "kept.labels")).alias("labels"),
        F.when(F.size("places") > 0, F.greatest(F.lit(0.8), "kept.score")).otherwise(F.col("kept.score")).alias("score"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"), F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


QUERIES = {"op10_license_scan": (op10_license_scan, None)}
