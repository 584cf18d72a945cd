"""Secret scan through a trigram inverted index.

Each rule's regex is turned into a Boolean trigram query (OR of ANDs). The index holds, for every row, its postings
of the trigrams that some query names; they are made and intersected per clause where the row is read, so
that no text leaves its task, and only rows that satisfy a rule's query are read with its regex. A rule without
mandatory trigrams is scanned on every row.

Cases: a null text is read as empty. Repeated rows and null ids keep one output row each. Spans are
code points, end exclusive. All matches of a kind are leftmost and do not overlap; matches shorter
than the rule's least length use up their text and are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STRINGS, MAX_CLASS = 64, 8
BLOCK = 128
SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """One kind of secret: a regex, and the least length of one of its groups.

    ``base`` marks the kinds that ``base_sha256`` of the query covers.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = True


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


NAMES = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
# A run that is too short holds no longer match, so the bound of these runs stands in the regex.
# That does not hold for assignments: "token=token:abcdefgh" must use up the second name.
RULES = (
    Rule("assign", f"({NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    # To the matching END line; without one, over what follows of base64 and line ends. Five dashes end the run, so
    # that a key without an END is read to the next BEGIN only. Classes and a bounded group: a group repeated
    # without bound would take stack for each line of a long text.
    Rule(
        "private_key",
        "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[A-Za-z0-9+/=,:.\\x5c\\x20\\t\\r\\n]*(?:-{1,4}[A-Za-z0-9+/=,:.\\x5c\\x20\\t\\r\\n]+){0,40}-----END [A-Z ]{0,40}PRIVATE KEY-----|(?:\\x5c[rn]|[\\r\\n])[A-Za-z0-9+/=\\x5c\\r\\n]*)?",
        base=False,
    ),
)


# --- Boolean trigram queries -----------------------------------------------------------------


def _absorbed(clauses: Iterable[frozenset[str]]) -> list[frozenset[str]]:
    """Drop clauses that another clause contains: A or (A and B) is A."""
    out: list[frozenset[str]] = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(o <= c for o in out):
            out.append(c)
    return out


def _of_strings(strings: set[str]) -> list[frozenset[str]]:
    return _absorbed(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    """a and b; if that has too many clauses, the one whose weakest clause asks for more."""
    if len(a) * len(b) > MAX_STRINGS:
        return max(a, b, key=lambda q: min(map(len, q)))
    return _absorbed(x | y for x in a for y in b)


def _walk(node) -> tuple[set[str] | None, list[frozenset[str]]]:
    """(all strings a part of a regex matches if they are few, else None; its trigram query)."""
    true = [frozenset()]
    query, run = true, {""}
    whole = True
    for op, arg in node:
        few, inner, more = None, true, False
        if op is sre.LITERAL:
            few = {chr(arg).lower()}
        elif op is sre.IN:
            few = set()
            for kind, value in arg:
                if kind is sre.LITERAL:
                    few.add(chr(value).lower())
                elif kind is sre.RANGE and value[1] - value[0] < MAX_CLASS:
                    few |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    few = None
                    break
            few = few if few is not None and len(few) <= MAX_CLASS else None
        elif op is sre.SUBPATTERN:
            few, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            parts = [_walk(p) for p in arg[1]]
            if all(p[0] is not None for p in parts):
                few = set().union(*(p[0] for p in parts))
            else:
                inner = _absorbed(c for p in parts for c in p[1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, part = arg
            few, inner = _walk(part)
            if low == 0:
                few, inner = (few | {""} if few is not None and high == 1 else None), true
            elif few is not None and high != 1:
                more = True
        elif op is sre.AT:
            continue
        joined = {a + b for a in run for b in few} if few is not None else None
        if joined is not None and len(joined) <= MAX_STRINGS:
            run = joined
        else:
            query, whole = _both(query, _of_strings(run)), False
            run = few if few is not None and len(few) <= MAX_STRINGS else {""}
            query = _both(query, inner)
        if more:
            query, whole, run = _both(query, _of_strings(run)), False, {""}
    return (run if whole else None), _both(query, _of_strings(run))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of lower-case trigrams; every match holds all trigrams of some clause.

    An empty clause means that nothing is mandatory.
    """
    return _walk(_parser.parse(pattern))[1]


# --- index and postings ----------------------------------------------------------------------


def held_trigrams(low: Column, rules: tuple[Rule, ...]) -> Column:
    """A row's postings: those trigrams of the rules' queries that its lower-cased text holds."""
    terms = sorted({t for rule in rules for clause in trigram_query(rule.pattern) for t in clause})
    held = [F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in terms]
    return F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")


def satisfied(held: Column, rule: Rule) -> Column:
    """Whether the postings hold all trigrams of some clause of the rule's query."""
    clauses = [F.size(F.array_except(F.array(*map(F.lit, sorted(c))), held)) == 0 if c else F.lit(True) for c in trigram_query(rule.pattern)]
    return reduce(lambda x, y: x | y, clauses)


# --- verification ----------------------------------------------------------------------------


def _spans(n: int, rule: Rule) -> Column:
    """Spans from the matches m, the pieces between them p and the tested groups g.

    Places are summed in blocks of ``BLOCK`` matches and then over the blocks, so that no list is copied
    once per match of a long text.
    """
    many = F.size(f"m{n}")
    lengths = F.transform(
        F.sequence(F.lit(0), many - 1),
        lambda i: F.struct(
            F.length(F.get(f"p{n}", i)).alias("gap"), F.length(F.get(f"m{n}", i)).alias("own"), F.length(F.get(f"g{n}", i)).alias("tested")
        ),
    )

    def placed(block: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,tested:int>>").alias("out"))
        return F.aggregate(
            block,
            none,
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["own"]).alias("end"), x["tested"].alias("tested"))),
                ).alias("out"),
            ),
        )

    starts = F.sequence(F.lit(0), F.floor((many - 1) / BLOCK).cast("int"))
    # The lengths are bound once for all blocks.
    blocks = F.flatten(F.transform(F.array(lengths), lambda all_: F.transform(starts, lambda b: placed(F.slice(all_, b * BLOCK + 1, BLOCK)))))

    def joined(parts: Column) -> Column:
        before = F.aggregate(
            parts,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(
            F.zip_with(
                parts,
                before,
                lambda x, at: F.transform(
                    F.filter(x["out"], lambda s: s["tested"] >= rule.least),
                    lambda s: F.struct((s["start"] + at).alias("start"), F.lit(n).alias("ord"), (s["end"] + at).alias("end"), F.lit(rule.kind).alias("kind")),
                ),
            )
        )

    return F.when(many > 0, F.flatten(F.transform(F.array(blocks), joined))).otherwise(F.array().cast(SPAN))


def find_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, text, spans, and ``rest`` with the columns to keep) of every row.

    Spans are sorted by start, then by the rules' order. Other columns of ``docs`` are left out, and
    kept ones are nested, so none of them can clash.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), rest.alias("rest"))
    low = rows.withColumn("low", F.lower("text"))
    held = low.select("id", "text", "rest", held_trigrams(F.col("low"), rules).alias("held"))
    none = F.array().cast("array<string>")
    parts = [(satisfied(F.col("held"), rule) & F.col("text").rlike(rule.pattern)).alias(f"h{n}") for n, rule in enumerate(rules)]
    rows = held.select("id", "text", "rest", *parts)
    parts = []
    for n, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        parts += [
            F.when(F.col(f"h{n}"), F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none).alias(f"m{n}"),
            F.when(F.col(f"h{n}"), F.split("text", rule.pattern, -1)).otherwise(none).alias(f"p{n}"),
            F.when(F.col(f"h{n}"), F.regexp_extract_all("text", pattern, F.lit(rule.group)))
            .otherwise(none)
            .alias(f"g{n}"),
        ]
    rows = rows.select("id", "text", "rest", *parts)
    spans = F.array_sort(F.flatten(F.array(*(_spans(n, r) for n, r in enumerate(rules)))))
    return rows.select(F.col("id").alias(id_col), F.col("text").alias(text_col), spans.alias("spans"), "rest")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with each run of overlapping or touching spans replaced by one mask."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    joined = F.aggregate(
        spans,
        state,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when((s["start"] <= acc["at"]) & (F.size(acc["out"]) > 0), acc["out"])
            .otherwise(
                F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
            )
            .alias("out"),
        ),
        lambda acc: F.array_join(
            F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text)))), ""
        ),
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns, secrets masked in the text; ``n_chars``, if there, follows. Null texts stay null."""
    found = find_secrets(docs, rules, id_col, text_col, tuple(docs.columns))
    # Two steps: within one, "text" in a lambda would mean the masked text of the same select.
    masked = found.select("rest", F.when(F.size("spans") > 0, redacted(F.col(text_col), F.col("spans"))).alias("_masked"))

    def column(name: str) -> Column:
        old = F.col("rest")[name]
        if name == text_col:
            return F.coalesce("_masked", old).alias(name)
        if name == "n_chars":
            return F.coalesce(F.length("_masked").cast(docs.schema[name].dataType), old).alias(name)
        return old.alias(name)

    return masked.select(*map(column, docs.columns))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    base = [r.kind for r in rules if r.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        id_col,
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
