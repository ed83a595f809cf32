"""Secret scans through a trigram index.

Of each rule's regular expression a Boolean trigram query is derived: every finite
stretch of the expression (literals, small classes, optional parts, alternatives) gives
one clause, an OR over its possible strings of the AND of their trigrams. The index
holds a posting (trigram, document key) for every trigram of any rule and every document
that has it, upper and lower case alike. A rule's candidates are the documents whose
postings meet all its clauses; only those are searched. A rule without a clause scans
every document.

Spans are code point ranges, end exclusive, found from left to right without overlap
within a rule. A match that fails its rule's length is dropped after it was consumed.

Everything is DataFrame work on whole texts. Postings of one document meet in one group
of at most as many rows as there are trigrams in all rules; the key holds id and text,
so a trigram that many documents share is no hot key.

Defined results: a null or empty text has no spans. Repeated rows are searched alike.
Other columns of the input are kept by `redact`.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.fingerprint import let
from recordloom.llm.ship import set_aside, stored


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0  # group whose length counts
    least: int = 0

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The kinds every scan has, in the order of equal starts.
BASE_RULES = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        any_case=True, group=2, least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
]
# Published forms of service tokens and keys.
MORE_RULES = [
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = BASE_RULES + MORE_RULES
MOST_STRINGS = 64
MOST_OF_A_CLASS = 6

# --- trigram queries --------------------------------------------------------------

Clause = frozenset[frozenset[str]]


def _class_members(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is rc.LITERAL:
            found.add(chr(value).lower())
        elif op is rc.RANGE and value[1] - value[0] < 4 * MOST_OF_A_CLASS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_OF_A_CLASS else None


def _strings(op, value) -> set[str] | None:
    """All strings an item can match in lower case, or None if they are too many."""
    if op is rc.LITERAL:
        return {chr(value).lower()}
    if op is rc.IN:
        return _class_members(value)
    if op is rc.SUBPATTERN:
        return _sequence_strings(value[3])
    if op is rc.BRANCH:
        parts = [_sequence_strings(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, inner = value
        one = _sequence_strings(inner)
        if one is None or high is rc.MAXREPEAT or len(one) ** high > MOST_STRINGS:
            return None
        tries = (itertools.product(sorted(one), repeat=n) for n in range(low, high + 1))
        return {"".join(t) for n in tries for t in n}
    return {""} if op is rc.AT else None


def _sequence_strings(items) -> set[str] | None:
    found = {""}
    for op, value in items:
        more = _strings(op, value)
        if more is None or len(found) * len(more) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in more}
    return found


def _clause(strings: set[str]) -> Clause | None:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    # A string whose trigrams include another string's adds nothing.
    return frozenset(a for a in sets if not any(b < a for b in sets))


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that the trigrams of every matching text meet; empty: no such clause."""
    clauses: list[Clause] = []

    def flush(run: set[str]) -> set[str]:
        clause = _clause(run)
        if clause and clause not in clauses:
            clauses.append(clause)
        return {""}

    def walk(items) -> None:
        run = {""}
        for op, value in items:
            more = _strings(op, value)
            if more is not None and len(run) * len(more) <= MOST_STRINGS:
                run = {a + b for a in run for b in more}
                continue
            if op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and value[0] > 0:
                # What must come at least once belongs to the run before it.
                more = _sequence_strings(value[2])
                if more is not None and len(run) * len(more) <= MOST_STRINGS:
                    run = {a + b for a in run for b in more}
            run = flush(run)
            if more is not None and op not in (rc.MAX_REPEAT, rc.MIN_REPEAT):
                run = more
            elif op is rc.SUBPATTERN:
                walk(value[3])
        flush(run)

    walk(rp.parse(pattern))
    return clauses


# --- index ------------------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with `__key`, which rows of the same id and text share."""
    return docs.withColumn("__key", F.xxhash64("doc_id", "text"))


def postings(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Inverted index (`gram`, `key`) of the trigrams that the rules ask for."""
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) for s in c for g in s})
    low = docs.select(F.col("__key").alias("key"), F.lower("text").alias("low"))
    present = F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams])
    return low.select("key", F.explode(F.array_compact(present)).alias("gram")).distinct()


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Documents that meet a rule's query: `key` and the kinds to search for."""
    met = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    kinds = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        if not query:
            continue
        test = F.lit(True)
        for clause in query:
            either = F.lit(False)
            for grams in sorted(map(sorted, clause)):
                all_of = F.array(*map(F.lit, grams))
                either = either | (F.size(F.array_intersect("grams", all_of)) == len(grams))
            test = test & either
        kinds.append(F.when(test, F.lit(rule.kind)))
    kinds = F.array_compact(F.array(*kinds))
    return met.select("key", kinds.alias("kinds")).filter(F.size("kinds") > 0)


# --- spans ------------------------------------------------------------------------

_CHUNK = 256


def _running(lengths: Column) -> Column:
    """Sums of all earlier entries, in chunks so that the work stays near linear."""

    def sums(values: Column, start: Column) -> Column:
        last = lambda acc: F.element_at(acc, -1)
        grown = F.aggregate(
            values, F.array(start), lambda acc, x: F.concat(acc, F.array(last(acc) + x))
        )
        return F.slice(grown, F.lit(1), F.size(values))

    def chunked(values: Column) -> Column:
        count = F.floor((F.size(values) - 1) / _CHUNK).cast("int")
        chunks = F.transform(
            F.sequence(F.lit(0), count), lambda c: F.slice(values, c * _CHUNK + 1, F.lit(_CHUNK))
        )

        def joined(parts: Column) -> Column:
            totals = F.transform(
                parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + x)
            )
            return F.flatten(F.zip_with(parts, sums(totals, F.lit(0)), sums))

        return let(chunks, joined)

    return F.when(F.size(lengths) == 0, lengths).otherwise(let(lengths, chunked))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in one text, as (start, rank, kind, end)."""
    regex = F.lit(rule.regex)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def located(found: Column) -> Column:
        def built(gaps: Column) -> Column:
            def placed(begins: Column) -> Column:
                def span(i: Column) -> Column:
                    start = F.get(begins, i) + F.get(gaps, i)
                    return F.struct(
                        start.alias("start"),
                        F.lit(rank).alias("rank"),
                        F.lit(rule.kind).alias("kind"),
                        (start + F.length(F.get(found["whole"], i))).alias("end"),
                        F.length(F.get(found["part"], i)).alias("size"),
                    )

                every = F.transform(F.sequence(F.lit(0), F.size(found["whole"]) - 1), span)
                long = F.filter(every, lambda s: s["size"] >= rule.least)
                return F.transform(
                    long, lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])
                )

            both = F.zip_with(
                F.slice(gaps, F.lit(1), F.size(found["whole"])), found["whole"],
                lambda g, m: g + F.length(m),
            )
            return let(_running(both), placed)

        gaps = F.transform(F.split(text, rule.regex, -1), F.length)
        return let(gaps, built)

    found = F.struct(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("part"),
    )
    # Texts without a long enough match need no positions.
    return F.when(text.rlike(_sieve(rule)), let(found, located)).otherwise(none)


def _sieve(rule: Rule) -> str:
    """A quick test that every text with a kept match passes."""
    if rule.least and not rule.group:
        head = rule.pattern.rsplit("[", 1)
        fixed = len(head[0])
        return f"{head[0]}[{head[1].removesuffix('+')}{{{rule.least - fixed},}}"
    return rule.regex


def find_secrets(docs: DataFrame, keep: list[str], rules: list[Rule] | None = None) -> DataFrame:
    """Columns `keep` and `spans`, an array of (start, rank, kind, end) in that order."""
    rules = rules or RULES
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = keyed(docs.withColumn("text", text))
    index = stored(postings(rows, rules), "postings")
    wanted = candidates(index, rules)
    joined = rows.join(wanted, F.col("__key") == F.col("key"), "left")
    parts = []
    for rank, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, rank)
        if trigram_query(rule.pattern):
            none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
            listed = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            spans = F.when(listed, spans).otherwise(none)
        parts.append(spans)
    return joined.select(*keep, F.sort_array(F.flatten(F.array(*parts))).alias("spans"))


def listed(spans: Column, where: Callable[[Column], Column] | None = None) -> Column:
    """`kind:start:end`, comma-joined."""
    chosen = F.filter(spans, where) if where else spans
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of its text replaced by a mark, and n_chars, if there is one, renewed.

    Spans that overlap are replaced together. Other columns are kept, whatever their names.
    """
    inner = set_aside(docs, ["doc_id", "text"])
    found = find_secrets(docs.toDF(*inner.values()), list(inner.values()))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, span: Column) -> Column:
        fresh = span["start"] >= acc["at"]
        between = F.substring(F.col("text"), acc["at"] + 1, span["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(acc["parts"], F.array(between, F.lit(mark))))
            .otherwise(acc["parts"])
            .alias("parts"),
        )

    def text(done: Column) -> Column:
        rest = F.substring(F.col("text"), done["at"] + 1, F.length("text"))
        return F.concat(F.array_join(done["parts"], ""), rest)

    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        let(F.aggregate("spans", start, step), text)
    )
    changed = found.withColumn("__clean", clean)
    named = {"text": F.col("__clean")}
    if "n_chars" in inner:
        before = F.col(inner["n_chars"])
        renewed = F.length("__clean").cast(docs.schema["n_chars"].dataType)
        named["n_chars"] = F.when(F.size("spans") == 0, before).otherwise(renewed)
    return changed.select(*[named.get(c, F.col(i)).alias(c) for c, i in inner.items()])
