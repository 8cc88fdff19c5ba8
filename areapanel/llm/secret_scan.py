"""Secret scans through a trigram inverted index, with DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A kind of secret. ``pattern`` is matched leftmost and without overlaps; a match is kept if its
    group ``group`` has ``least`` characters. ``literals`` are the sub-patterns every match holds,
    one of each tuple; optional characters are marked by ``?``."""

    kind: str
    pattern: str
    group: int
    least: int
    required: tuple[tuple[str, ...], ...]


# The patterns that must be found. The kinds from ``pem`` on are the method's own.
RULES: tuple[Rule, ...] = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        (("password", "passwd", "secret", "token", "api_?key"),),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, (("AKIA",),)),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, ()),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, (("-----BEGIN ",), ("PRIVATE KEY-----",))),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, ((".eyJ",),)),
)


def alternatives(literal: str) -> list[str]:
    """The texts a literal with optional characters stands for."""
    at = literal.find("?")
    if at < 1:
        return [literal]
    return [x for middle in ("", literal[at - 1]) for x in alternatives(literal[: at - 1] + middle + literal[at + 1 :])]


def trigrams(text: str) -> list[str]:
    lower = text.lower()
    return sorted({lower[i : i + 3] for i in range(len(lower) - 2)})


def trigram_query(rule: Rule) -> list[list[list[str]]]:
    """AND of ORs of ANDs of trigrams that every match of the rule has; empty if none is mandatory."""
    clauses = []
    for options in rule.required:
        grams = [trigrams(text) for literal in options for text in alternatives(literal)]
        if all(grams):
            clauses.append(grams)
    return clauses


def vocabulary(rules: Sequence[Rule]) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r) for option in clause for g in option})


def postings(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The inverted index over the trigrams the rules ask for: a row per trigram and document that has it."""
    listed = vocabulary(rules)
    lower = F.lower(F.coalesce(F.col("text"), F.lit("")))
    hits = F.array_compact(F.array(*[F.when(F.contains("_lower", F.lit(g)), F.lit(i)) for i, g in enumerate(listed)]))
    return docs.select(F.col("doc_id"), lower.alias("_lower")).select("doc_id", F.explode(hits).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id and the rules whose trigram query its postings meet, as one Boolean column per rule.

    The postings of a document meet in one group of at most as many rows as there are trigrams.
    """
    listed = {g: i for i, g in enumerate(vocabulary(rules))}

    def has(gram: str) -> Column:
        return F.array_contains("_found", F.lit(listed[gram]))

    met = []
    for number, rule in enumerate(rules):
        clauses = trigram_query(rule)
        if clauses:
            parts = [reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, map(has, o)) for o in c]) for c in clauses]
            met.append(reduce(lambda a, b: a & b, parts).alias(f"_rule{number}"))
    grouped = postings(docs, rules).groupBy("doc_id").agg(F.collect_set("trigram").alias("_found"))
    names = [f"_rule{n}" for n, r in enumerate(rules) if trigram_query(r)]
    return grouped.select(F.col("doc_id").alias("_doc"), *met).where(reduce(lambda a, b: a | b, [F.col(n) for n in names]))


def matches(text: Column, rule: Rule, kind: int) -> Column:
    """Spans (start, kind, end) of a rule, from the pieces between its matches."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    valued = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    sized = F.transform(
        F.arrays_zip(whole.alias("w"), valued.alias("v"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g")),
        lambda x: F.struct(F.char_length(x["g"]).alias("g"), F.char_length(x["w"]).alias("w"), F.char_length(x["v"]).alias("v")),
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    folded = F.aggregate(
        sized,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + x["w"]).alias("at"),
            F.when(
                x["v"] >= rule.least,
                F.concat(
                    a["out"],
                    F.array(F.struct((a["at"] + x["g"]).alias("start"), F.lit(kind).alias("kind"), (a["at"] + x["g"] + x["w"]).alias("end"))),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
    )["out"]
    return F.when(F.regexp(text, F.lit(rule.pattern)), folded).otherwise(empty)


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and ``found``, the sorted spans (start, kind, end) in code points, end exclusive.

    Rules with mandatory trigrams are verified only where the index has a candidate; the others scan
    every text. Candidates are joined by id, null ids with null ids, as a superset: rows that share an
    id share their candidates and are verified each by its own text. A null text is empty.
    """
    text = F.col("_text")
    given = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    joined = given.join(candidates(docs, rules), F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for number, rule in enumerate(rules):
        spans = matches(text, rule, number)
        if trigram_query(rule):
            spans = F.when(F.col(f"_rule{number}"), spans).otherwise(empty)
        found.append(spans)
    return joined.select("doc_id", F.sort_array(F.concat(*found)).alias("found"))


def secret_scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document the base kinds' counts, the sha256 of their spans, and all spans as text."""
    names = F.array(*[F.lit(r.kind) for r in rules])

    def joined(kinds: int) -> Column:
        listed = F.filter("found", lambda s: s["kind"] < kinds)
        return F.array_join(F.transform(listed, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return secret_spans(docs, rules).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(3).cast("binary"), 256).alias("base_sha256"),
        joined(len(rules)).alias("spans"),
    )


def brute_spans(text: str | None, rules: Sequence[Rule] = RULES) -> list[tuple[int, int, int]]:
    """The same spans of one text by Python's own matcher, for tests."""
    return sorted(
        (m.start(), n, m.end()) for n, r in enumerate(rules) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least
    )
