"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans; labelers of four kinds (shape, validity, gazetteer, context) vote on each;
expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is; and
a span classifier fitted to its posteriors decides on the spans that the base rules do not settle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrank.llm.common import fresh

# The patterns of the base kinds. A run that fails is not tried again from its middle,
# which changes no match and keeps long runs linear; nothing follows the possessive parts, so they
# match what greedy ones would. Runs of digits are whole, so a card's least length can stand here.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![A-Za-z0-9+.-])(?<!\+[0-9]{1,3}[\x20-])\(?[0-9]{3}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,4}(?![0-9]|[.-][0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Madame|Monsieur)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})?(?![A-Za-z])",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
# The gazetteers, in lower case.
POINTS_TO = r"(?:phone|tel|call|mobile|fax|e-?mail|mail|contact|ssn|social|card|visa|iban|account|konto|name|address|reach|ip|host|from)\W{0,3}(?:\w{1,8}\W{1,3}){0,2}$"
POINTS_AWAY = r"(?:version|page|isbn|order|fig|figure|total|section|chapter|build|release|[$€£#])\W{0,3}$"
#: Characters before a span that the gazetteer labeler reads.
BEFORE = 32
LABELERS = ("shape", "validity", "gazetteer", "context")
EM_ROUNDS, FIT_ROUNDS = 60, 400
#: Parts of a text whose running lengths are summed together.
BLOCK = 256
MARK, INSTEAD = "\x01", "\x02"  # white space to none of the patterns, so one may stand for the other


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.reverse(F.split(digits, "")), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at")),
        lambda acc, d: F.struct(
            (acc["sum"] + F.when(acc["at"] % 2 == 0, F.coalesce(d.try_cast("int"), F.lit(0)))
             .otherwise((F.coalesce(d.try_cast("int"), F.lit(0)) * 2) % 10 + F.floor(F.coalesce(d.try_cast("int"), F.lit(0)) / 5).cast("int"))).alias("sum"),
            (acc["at"] + 1).alias("at")),
    )
    return total["sum"] % 10 == 0


def _iban_ok(text: Column) -> Column:
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda acc, c: F.when(c == "", acc).when(c.rlike("[0-9]"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _valid(kind: str, text: Column) -> Column:
    """Whether a match is valid: for the base kinds, whether it is reported whatever the votes."""
    n = F.length(_digits(text))
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(text))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "number":
        return n.between(9, 11)
    if kind == "iban":
        return _iban_ok(text)
    if kind == "person":
        return text.rlike(r"[A-Z][a-z]+ [A-Z][a-z]+$")
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _shape(kind: str, text: Column) -> Column:
    if kind == "email":
        return _vote(text.rlike(r"\.[A-Za-z]{2,12}$"), ~text.rlike(r"\.[A-Za-z]{2,12}$"))
    if kind == "ip":
        return _vote(text.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), text.rlike("[0-9]{4}"))
    if kind == "card":
        return _vote(text.rlike(r"^[0-9]{4}([ -]?[0-9]{4}){3}$"), text.rlike(r"^[0-9]{1,12}$"))
    if kind == "phone":
        return _vote(text.rlike(r"^\+[0-9]{1,3}[ (-]"), text.rlike(r"[ ().-]{4}"))
    if kind == "number":
        return _vote(text.rlike(r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})$"), F.lit(True))
    return F.lit(1)


def _found(text: Column, kind: str, parts: Column) -> Column:
    """Array of the matches of a kind, from the text split at its marks: gaps and matches in turn.

    Places are running sums of lengths, in blocks and over blocks, so many matches cost little each."""
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    zero = F.array(F.lit(0).cast("bigint"))
    blocks = F.transform(
        numbers(F.ceil(F.size(parts) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(parts, b * BLOCK + 1, BLOCK), zero, lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p)))),
    )

    def span(own: Column, i: Column) -> Column:
        block = lambda k: F.get(own["blocks"], F.floor(k / BLOCK).cast("int"))
        place = lambda k: F.get(own["bases"], F.floor(k / BLOCK).cast("int")) + F.get(block(k), k % BLOCK)
        match, before, after = F.get(parts, i), F.right(F.get(parts, i - 1), F.lit(BEFORE)), F.left(F.get(parts, i + 1), F.lit(1))
        around = F.concat(F.right(before, F.lit(1)), F.lit(" "), after)
        valid = _valid(kind, match)
        votes = {
            "shape": _shape(kind, match), "validity": _vote(valid, ~valid),
            "gazetteer": _vote(F.lower(before).rlike(POINTS_TO), F.lower(before).rlike(POINTS_AWAY)),
            "context": _vote(~around.rlike(r"[A-Za-z0-9_/=-]"), F.lit(True)),
        }
        return F.struct(
            F.lit(kind).alias("kind"), place(i).alias("start"), place(i + 1).alias("end"), valid.alias("valid"),
            F.struct(*(v.cast("int").alias(k) for k, v in votes.items()), F.least(F.length(match) / 8, F.lit(4)).cast("int").alias("size")).alias("votes"),
        )

    def spans(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: span(own, i))

    def with_bases(found: Column) -> Column:
        bases = F.aggregate(found, zero, lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.element_at(b, -1))))
        return F.struct(found.alias("blocks"), bases.alias("bases"))

    # An array of one element carries a value that several places read.
    once = F.transform(F.transform(F.array(blocks), with_bases), spans)
    return F.when(F.size(parts) > 1, F.get(once, F.lit(0)))


def candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with column ``out``: for each kind the array of its matches, null where there is none.

    A match is marked in the text by a character that no pattern takes (where the text has it, another
    such character stands in), and the text is split there; so places are sums of lengths, and a
    text is read once for each kind, whatever it holds.
    """
    clean, parts = fresh(docs, "_clean"), fresh(docs, "_parts")
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn(clean, F.when(F.contains(t, F.lit(MARK)), F.translate(t, MARK, INSTEAD)).otherwise(t))
    digit = F.col(clean).rlike("[0-9]")
    marked = {}
    for kind, pattern in PATTERNS.items():
        replaced = F.split(F.regexp_replace(F.col(clean), pattern, f"{MARK}$0{MARK}"), MARK, -1)
        needs = {"email": F.contains(F.col(clean), F.lit("@")), "phone": F.contains(F.col(clean), F.lit("+")), "person": F.lit(True)}.get(kind, digit)
        marked[kind] = F.when(needs, replaced).otherwise(F.array(F.lit("")))
    rows = rows.withColumn(parts, F.struct(*(c.alias(k) for k, c in marked.items())))
    found = F.struct(*(_found(F.col(clean), k, F.col(parts)[k]).alias(k) for k in KINDS))
    return rows.withColumn(out, found).drop(clean, parts)


@dataclass
class SpanModel:
    """Weights of the final classifier by feature ("kind=email", "shape=1", ...), and what the
    expectation-maximisation found: P(vote | class) by labeler, and P(personal) by kind."""

    weights: dict[str, float]
    reliability: dict[str, dict[tuple[int, int], float]]
    prior: dict[str, float]

    def accepts(self, kind: str, votes: Column) -> Column:
        """The classifier on a struct of votes. A span needs a positive score and no failed validity."""
        score = F.lit(self.weights.get("bias", 0.0) + self.weights.get(f"kind={kind}", 0.0))
        for name in (*LABELERS, "size"):
            values = [(int(f.split("=")[1]), w) for f, w in self.weights.items() if f.startswith(name + "=")]
            term = reduce(lambda c, v: c.when(votes[name] == v[0], F.lit(v[1])), values, F.when(F.lit(False), F.lit(0.0)))
            score = score + term.otherwise(F.lit(0.0))
        return (score > 0) & (votes["validity"] >= 0)


def estimate(patterns: list[tuple[str, tuple[int, ...], int, float]]) -> SpanModel:
    """From rows (kind, votes, size, count): EM with independent labelers, then a logistic regression on
    kind, votes and size fitted to the posteriors. The rows are vote patterns, a few hundred at most."""
    if not patterns:
        return SpanModel({"bias": -1.0}, {}, {})
    kinds = sorted({k for k, *_ in patterns})
    values = (-1, 0, 1)
    post = [1 / (1 + math.exp(-2.0 * sum(v) + 1.0)) for _, v, _, _ in patterns]
    for _ in range(EM_ROUNDS):
        prior = {}
        for kind in kinds:
            rows = [(p, n) for p, (k, _, _, n) in zip(post, patterns, strict=True) if k == kind]
            prior[kind] = (sum(p * n for p, n in rows) + 1) / (sum(n for _, n in rows) + 2)
        said = {}
        for at, name in enumerate(LABELERS):
            mass = {(c, v): 1.0 for c in (0, 1) for v in values}
            for p, (_, votes, _, n) in zip(post, patterns, strict=True):
                mass[1, votes[at]] += p * n
                mass[0, votes[at]] += (1 - p) * n
            said[name] = {(c, v): mass[c, v] / sum(mass[c, x] for x in values) for c, v in mass}
        post = []
        for kind, votes, _, _ in patterns:
            margin = math.log(prior[kind] / (1 - prior[kind]))
            margin += sum(math.log(said[m][1, v] / said[m][0, v]) for m, v in zip(LABELERS, votes, strict=True))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))))
    rows = []
    for p, (kind, votes, size, n) in zip(post, patterns, strict=True):
        rows.append((["bias", f"kind={kind}", *(f"{m}={v}" for m, v in zip(LABELERS, votes, strict=True)), f"size={size}"], p, n))
    total = sum(n for *_, n in rows)
    weights = dict.fromkeys(sorted({f for fs, *_ in rows for f in fs}), 0.0)
    for _ in range(FIT_ROUNDS):
        gradient = dict.fromkeys(weights, 0.0)
        for features, p, n in rows:
            margin = sum(weights[f] for f in features)
            d = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))) - p) / total
            for f in features:
                gradient[f] += d
        for f in weights:
            weights[f] -= 1.0 * (gradient[f] + 1e-4 * weights[f])
    return SpanModel(weights, said, prior)


def train_spans(docs: DataFrame, text: str = "text") -> SpanModel:
    """Counts the vote patterns of all candidates in all documents and estimates the model. What
    reaches the driver is a row for each pattern that occurs: at most 7 kinds x 81 votes x 5 sizes."""
    rows = candidates(docs.select(F.col(text).alias("text")), "text", "found")
    every = F.concat(*(F.coalesce(F.col("found")[k], F.array().cast(_SPANS)) for k in KINDS))
    span = rows.select(F.explode(every).alias("s"))
    counted = span.groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes")).count().collect()
    return estimate(sorted((r["kind"], tuple(r.votes[m] for m in LABELERS), r.votes["size"], float(r["count"])) for r in counted))


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,valid:boolean,votes:struct<shape:int,validity:int,gazetteer:int,context:int,size:int>>>"


def _reported(found: Column, model: SpanModel) -> dict[str, Column]:
    """Per kind the spans to report: valid ones of the base kinds, and those that the classifier accepts."""
    out = {}
    for kind in KINDS:
        keep = (lambda s: s["valid"]) if kind in BASE else (lambda s, k=kind: model.accepts(k, s["votes"]))
        spans = F.transform(F.filter(found[kind], keep), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        out[kind] = F.coalesce(spans, F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    return out


def find_personal_data(docs: DataFrame, model: SpanModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end) by kind, then start; code points, end exclusive.

    Base kinds (email, ip, card, phone) are reported when their match is valid; further kinds when the
    classifier accepts them. A null text is empty; null ids and repeated rows pass through; other columns
    are not read. Texts are read whole and nothing is shuffled.
    """
    rows = candidates(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), "text", "found")
    return rows.select("doc_id", F.concat(*_reported(F.col("found"), model).values()).alias("spans"))


def mask_personal_data(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """The rows with every reported span replaced by its kind in brackets, other columns as they are. Spans
    that overlap become one, named after the one that starts first. A null text stays null."""
    found, spans = fresh(docs, "_found"), fresh(docs, "_spans")
    rows = candidates(docs, text, found)
    every = F.concat(*_reported(F.col(found), model).values())
    by_start = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))
    rows = rows.withColumn(spans, by_start)
    t = F.col(text)

    def add(acc: Column, s: Column) -> Column:
        fresh_span = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(t, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(fresh_span, piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], -s["last"]).alias("at"))

    done = F.aggregate(
        F.col(spans), F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")), add,
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"].cast("int") + 1, F.length(t))),
    )
    masked = F.when(F.size(spans) > 0, done).otherwise(t)
    return rows.withColumn(text, masked).select(*docs.columns)
