"""Secret scans through a trigram inverted index.

Each rule's regular expression says which trigrams every match must hold, as a Boolean
query. Postings (trigram to rows) of all the trigrams that some rule asks for are
intersected to candidate rows, and only those are searched with the expression. A rule
whose expression has no mandatory trigram searches every row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage, settle
from pagemill.llm.rows import FILE, ROW, located, shielded, text_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share. A match counts if its ``group``
    (0: all of it) has at least ``least`` characters; one that fails is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in order.
BASE = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # Runs of hex digits; a run too short can't match anywhere within itself either.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
RULES = BASE + (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
# Character classes up to this size are spelled out, others end a run of known characters.
SMALL_CLASS = 6


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams that a match must hold together.

    Empty if some way to match holds no trigram for certain.
    """
    # An alternative under construction: the known characters so far, and its trigrams.
    State = tuple[str, frozenset[str]]

    def add(states: set[State], char: str) -> set[State]:
        out = set()
        for run, found in states:
            run += char.lower()
            out.add((run[-3:], found | {run[-3:]} if len(run) >= 3 else found))
        return out

    def walk(nodes, states: set[State]) -> set[State]:
        for op, arg in nodes:
            op = str(op)
            if op == "LITERAL":
                states = add(states, chr(arg))
            elif op == "SUBPATTERN":
                states = walk(arg[-1], states)
            elif op == "BRANCH":
                states = set().union(*(walk(branch, states) for branch in arg[1]))
            elif op == "IN" and len(arg) <= SMALL_CLASS and all(str(o) == "LITERAL" for o, _ in arg):
                states = set().union(*(add(states, chr(c)) for _, c in arg))
            elif op == "MAX_REPEAT" and arg[:2] == (0, 1):
                states = states | walk(arg[2], states)
            elif op == "MAX_REPEAT" and arg[0] > 0:
                states = walk(arg[2], states)
                states = states if arg[:2] == (1, 1) else {("", found) for _, found in states}
            else:  # nothing is known of what matches here
                states = {("", found) for _, found in states}
        return states

    found = {trigrams for _, trigrams in walk(re._parser.parse(pattern), {("", frozenset())})}
    return [] if frozenset() in found else sorted((f for f in found if not any(o < f for o in found)), key=sorted)


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram`` and locator of every row that has it, letters in either case."""
    lowered = F.lower(text_of(rows))
    held = F.array_compact(F.array(*(F.when(F.contains(lowered, F.lit(t)), t) for t in trigrams)))
    return rows.select(F.explode(held).alias("trigram"), FILE, ROW)


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Locator and ``kinds`` of the rows in which the rules with trigrams may match."""
    clauses = [
        (trigram, rule.kind, n, len(clause))
        for rule in rules
        for n, clause in enumerate(trigram_query(rule.pattern))
        for trigram in sorted(clause)
    ]
    index = cut_lineage(postings(rows, sorted({c[0] for c in clauses})))
    # One row per trigram of a rule's query: as small as the rules.
    queries = rows.sparkSession.createDataFrame(clauses, "trigram string, kind string, clause int, size int")
    hits = index.join(F.broadcast(queries), "trigram").groupBy("kind", "clause", FILE, ROW, "size").count()
    return hits.where("count = size").groupBy(FILE, ROW).agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def matches(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Locator, ``nth`` rule, ``kind, start, end`` of all matches that count, in code points."""
    indexed = {rule.kind for rule in rules if trigram_query(rule.pattern)}
    text = F.col("_text")
    rows = rows.select(FILE, ROW, text_of(rows).alias("_text"))
    if indexed:
        may, _ = broadcast_if_small(cut_lineage(candidates(rows.withColumnRenamed("_text", "text"), rules)))
        rows = rows.join(may, [FILE, ROW], "left")

    def found(nth: int, rule: Rule) -> Column:
        """Lengths of what stands before each match, of the match and of its group."""
        pattern = F.lit(rule.pattern)
        lengths = F.arrays_zip(
            F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("hit"),
            F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("value"),
        )
        search = F.rlike(text, pattern)
        if rule.kind in indexed:
            search = F.array_contains("kinds", rule.kind) & search
        return F.when(
            search, F.struct(F.lit(nth).alias("nth"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"), lengths.alias("all"))
        )

    by_rule = rows.select(FILE, ROW, F.explode(F.array_compact(F.array(*(found(*r) for r in enumerate(rules))))).alias("r"))
    each = by_rule.select(FILE, ROW, "r.nth", "r.kind", "r.least", F.posexplode("r.all").alias("i", "m")).select(
        "*", F.col("m.gap").alias("gap"), F.col("m.hit").alias("hit"), F.col("m.value").alias("value")
    )
    # Matches and the gaps between them add up to positions; a partition is one text and rule.
    before = Window.partitionBy(FILE, ROW, "nth").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce("hit", F.lit(0))).over(before)
    placed = each.withColumn("end", end).where(F.col("hit").isNotNull() & (F.col("value") >= F.col("least")))
    return placed.select(FILE, ROW, "nth", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")


@shielded("text")
def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``start, nth, kind, end`` in that order.

    Positions are code points, the end exclusive; per kind matches are leftmost and don't
    overlap. A null text counts as empty; a text without secrets has an empty array.
    Repeated rows are scanned alike; an empty table stays empty; a column of ``docs`` named
    ``secrets`` is replaced.
    """
    rows = located(docs)
    # All matches of one text: bounded by its length.
    spans = F.sort_array(F.collect_list(F.struct("start", "nth", "kind", "end"))).alias("secrets")
    per_row = settle(docs.sparkSession, lambda: matches(rows, rules).groupBy(FILE, ROW).agg(spans))
    table, _ = broadcast_if_small(per_row)
    out = rows.join(table, [FILE, ROW], "left").drop(FILE, ROW)
    none = F.array().cast("array<struct<start:bigint,nth:int,kind:string,end:bigint>>")
    return out.withColumn("secrets", F.coalesce("secrets", none))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
