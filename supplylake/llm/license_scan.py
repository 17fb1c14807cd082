"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words in lower case, joined by single spaces.  Which keywords of the
rules it holds is one set operation on its words; only the rules of these are matched.
A rule's matches are marked inside the text by one replacement, and the places of the
marked words are the match's interval, so positions cost one pass a rule.  Matches then
are rows: level by level of priority, those that lie in a kept match of a better level or hold
one go, and of one level those that lie in another; running extremes over the matches
in order of their places decide this without comparing pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .license_rules import RULES, Rule

#: What parts words, and the phrases of the base with their labels.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: How far a match of each priority is believed to name the text's license.
BELIEF = {1: 0.99, 2: 0.95, 3: 0.8, 4: 0.4}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NO_WORD), "")


def _marked(tokens: Column, mark: str, end: bool = False) -> Column:
    """Numbers of the words that begin (or end) with ``mark``; the text begins with a space."""
    test = F.endswith if end else F.startswith
    return F.filter(F.transform(tokens, lambda t, i: F.when(test(t, F.lit(mark)), (i - 1).cast("long"))),
                    lambda i: i.isNotNull())


def base_places(line: Column, phrases: dict[str, str]) -> Column:
    """``label, start`` of every place of a phrase in a text's joined words."""
    kind = "array<struct<label:string,start:bigint>>"

    def places(phrase: str, label: str) -> Column:
        tokens = F.split(F.regexp_replace(line, f" (?={phrase} )", " \u0001"), " ")
        found = F.transform(_marked(tokens, "\u0001"), lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))
        return F.when(F.contains(line, F.lit(f" {phrase} ")), found).otherwise(F.array().cast(kind))
    return F.flatten(F.array(F.array().cast(kind), *(places(p, label) for p, label in phrases.items())))


def rule_matches(line: Column, present: Column, rules: list[Rule]) -> Column:
    """``rule, start, end`` (numbers of the first and last word) of every match of the
    rules whose keyword is present."""
    table = F.array(*(F.struct(F.lit(r.rule).alias("rule"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"))
                      for r in rules)).cast("array<struct<rule:int,keyword:string,pattern:string>>")

    def matches(r: Column) -> Column:
        tokens = F.split(F.regexp_replace(line, r["pattern"], F.lit("\u0001$0\u0002")), " ")
        pairs = F.arrays_zip(_marked(tokens, "\u0001").alias("start"), _marked(tokens, "\u0002", end=True).alias("end"))
        return F.transform(pairs, lambda p: F.struct(r["rule"].alias("rule"), p["start"].alias("start"), p["end"].alias("end")))

    tried = F.filter(table, lambda r: F.array_contains(present, r["keyword"]) & F.regexp_like(line, r["pattern"]))
    return F.flatten(F.transform(tried, matches))


def kept_matches(matches: DataFrame, levels: list[int]) -> DataFrame:
    """The rows of ``matches`` (``row, start, end, level, rule``) that no other one
    suppresses.  From the best level on: a match goes if it lies in a kept match of a
    better level or holds one, or lies in another match of its own level that did not go
    (of equal intervals, the first rule stays)."""
    ahead = Window.partitionBy("row").orderBy("start", F.desc("end"), "level", "rule").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("row").orderBy(F.desc("start"), "end", "level", "rule")
    out = matches.withColumn("kept", F.lit(False))
    for level in levels:
        own, kept = F.col("level") == level, F.col("kept")
        # equal intervals sort by level, so a better one is ahead in either order
        inside = F.coalesce(F.max(F.when(kept, F.col("end"))).over(ahead) >= F.col("end"), F.lit(False))
        holds = F.coalesce(F.min(F.when(kept, F.col("end"))).over(within.rowsBetween(Window.unboundedPreceding, -1)) <= F.col("end"),
                           F.lit(False))
        out = out.withColumn("open", own & ~inside & ~holds)
        beaten = F.coalesce(F.max(F.when(F.col("open"), F.col("end"))).over(ahead) >= F.col("end"), F.lit(False))
        out = out.withColumn("kept", F.col("kept") | (F.col("open") & ~beaten)).drop("open")
    return out.filter("kept").drop("kept")


def scan_licenses(documents: DataFrame, rules: list[Rule] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row of ``documents`` (``doc_id``, ``text``): ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score`` and as evidence ``detections``
    (``start, end, label, priority, rule`` of each kept match, in order).

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word`` are the
    least and greatest of their starts; ``labels`` holds the phrases' labels and those of
    the kept matches.  The score is the belief of the best evidence, 0 without any.  Null
    and empty texts hold no words and get empty labels; whole texts of any length are
    read; repeated rows are each returned, a null id stays null; an empty table gives no
    rows; other columns are never read.
    """
    rules = RULES if rules is None else rules
    phrases = BASE if phrases is None else phrases
    keywords = sorted({r.keyword for r in rules} | {p.split()[0] for p in phrases})
    # lower() may change more letters than A-Z, which neither parts words nor loses a keyword
    read = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("words", _words(F.lower("text")))
    held = read.select("doc_id", "text", F.size("words").cast("long").alias("n_words"),
                       F.array_intersect("words", F.array(*map(F.lit, keywords)).cast("array<string>")).alias("present"))
    line = F.concat(F.lit(" "), F.array_join(_words(F.translate("text", UPPER, UPPER.lower())), " "), F.lit(" "))
    lined = held.withColumn("line", F.when(F.size("present") > 0, line).otherwise(F.lit("")))
    scanned = saved(lined.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words",
        base_places(F.col("line"), phrases).alias("base"),
        rule_matches(F.col("line"), F.col("present"), rules).alias("matches")), "license-matches")
    base = scanned.select(
        "row", "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.start")).alias("first_word"), F.array_max(F.col("base.start")).alias("last_word"),
        F.array_sort(F.array_distinct(F.col("base.label"))).alias("base_list"), "matches")
    plain = base.filter(F.size("matches") == 0).withColumn("detections", F.array().cast(
        "array<struct<start:bigint,end:bigint,label:string,priority:int,rule:int>>"))
    columns = [c for c in base.columns if c != "matches"]
    if rules:
        by_rule = F.create_map(*(x for r in rules for x in (
            F.lit(r.rule), F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority")))))
        met = (base.select("row", F.explode("matches").alias("m")).select("row", "m.*")
               .withColumn("named", F.element_at(by_rule, F.col("rule")))
               .select("row", "start", "end", F.col("named.priority").alias("level"), "rule", F.col("named.label").alias("label")))
        found = (kept_matches(met, sorted({r.priority for r in rules})).groupBy("row")
                 .agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", F.col("level").alias("priority"), "rule"))).alias("detections")))
        plain = plain.select(*columns, "detections").unionByName(
            base.filter(F.size("matches") > 0).select(*columns).join(found, "row").select(*columns, "detections"))
    labels = F.array_sort(F.array_union("base_list", F.col("detections.label")))
    belief = F.create_map(*(x for k, v in BELIEF.items() for x in (F.lit(k), F.lit(v))))
    best = F.element_at(belief, F.array_min(F.col("detections.priority")))
    score = F.greatest(F.when(F.col("n_base") > 0, F.lit(BELIEF[2])).otherwise(F.lit(0.0)), F.coalesce(best, F.lit(0.0)))
    return plain.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_list", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                        score.alias("score"), "detections")
