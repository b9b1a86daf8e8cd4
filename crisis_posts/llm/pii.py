"""Personal data by bootstrapped contextual extraction.

Seeds are what four plain shapes find: e-mail addresses, IP addresses, card and phone numbers.
Around seeds and around every other identifier-like token (one that holds several digits or
an @, or a run of digit groups with single spaces between them) stand lexical patterns: the word before, the two words before, or the word before
and the word after. Spark scores the graph of patterns and instances in rounds: a pattern's
confidence for a kind is the mean belief in its distinct instances, an instance's belief is
one less the chance that all its accepted patterns are wrong, and seeds keep belief 1.
Patterns with enough distinct instances and confidence then mark the instances that no shape
knows.

Rows that leave the text scan are spans and candidates; the graph's tables hold one row for
each pattern and instance, summed before they are shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = None  # until nothing changes
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8

# Fixed shapes of the seeds, found leftmost and without overlap within a kind.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_TOKEN = re.compile(r"[^ \t-\r]+")
_DIGIT = re.compile(r"[0-9]")
_EDGE = "()[]{}<>\"'.,;:!?|*#&%$"
_MAX_TOKEN = 200
_PART = re.compile(r"""[^ \t-\r,;|"'<>{}()\[\]=&?#]+""")
# Tokens of digit groups with one space between them, up to edge punctuation.
_GROUP = r"[+(]*+[0-9][0-9().+/-]*+"
_RUN = re.compile(
    rf"""(?<![^ \t-\r"'\[{{<:*#|]){_GROUP}(?:(?<=[0-9)]) {_GROUP})+(?=[{re.escape(_EDGE)}]*+(?:[ \t-\r]|\Z))"""
)
_LEAST_DIGITS = 5
_WHOLE_DIGITS = 8  # a token of so many, the fewest of a phone's shape, stands alone
_MOST_DIGITS = 19
_BROADCAST_SPANS = 1_000_000
_SETTLED = 0.001


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with what may stand before it, back to the last match: one look at each character."""
    reach, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            reach = domain.end()
            yield start, reach
        at = text.find("@", max(at + 1, reach if domain else 0))


def _ip_fits(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _card_fits(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def seed_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; ends exclusive, in code points."""
    spans = [("email", *s) for s in _emails(text)]
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_fits(m.group())]
        spans += [("card", *m.span()) for m in _CARD.finditer(text) if _card_fits(m.group())]
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def _looks_identifying(token: str) -> bool:
    return "@" in token or len(_DIGIT.findall(token)) >= _LEAST_DIGITS


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what white space separates; long tokens are cut at punctuation."""
    for match in _TOKEN.finditer(text):
        start, end = match.span()
        if end - start <= _MAX_TOKEN:
            yield start, end
        else:
            yield from (part.span() for part in _PART.finditer(text, start, end))


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without joining signs at the end and brackets that the run doesn't close itself."""
    while text[end - 1] in "+-/.(":
        end -= 1
    while text[end - 1] == ")" and text.count(")", start, end) > text.count("(", start, end):
        end -= 1
    while text[start] == "(" and (
        text.find(")", start, end) < 0
        or text.find(")", start, end) == end - 1
        or text.count("(", start, end) > text.count(")", start, end)
    ):
        start, end = start + 1, end - (text[end - 1] == ")")
    return start, end


def _digit_runs(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of digit groups with single spaces between them, outside the spans.

    A run is cut between groups where it would hold more digits than any identifier.
    """
    at = 0
    for a, b in [*sorted(s[1:] for s in spans), (len(text), len(text))]:
        for match in _RUN.finditer(text, at, a) if a > at else ():
            start, end, digits = match.start(), match.start(), 0
            for group in _TOKEN.finditer(text, *match.span()):
                n = len(_DIGIT.findall(group.group()))
                if n >= _WHOLE_DIGITS or digits + n > _MOST_DIGITS:
                    if digits >= _LEAST_DIGITS:
                        yield _trimmed(text, start, end)
                    start, digits = group.start(), 0
                if n >= _WHOLE_DIGITS:
                    start = group.end() + 1
                else:
                    end, digits = group.end(), digits + n
            if digits >= _LEAST_DIGITS:
                yield _trimmed(text, start, end)
        at = max(at, b)


def _instance(text: str) -> str:
    """What stands for an instance in the graph: itself, or a digest if it is long."""
    return text if len(text) <= _MAX_TOKEN else hashlib.sha256(text.encode()).hexdigest()


def _patterns(before: list[str], after: str) -> list[str]:
    """Lexical patterns of an instance's surroundings."""
    out = []
    if before:
        out.append(f"{before[-1]} _")
        out.append(f"{before[-1]} _ {after}")
    if len(before) > 1:
        out.append(f"{before[-2]} {before[-1]} _")
    return out


def _word(token: str) -> str:
    return re.sub("[0-9]", "0", token.lower())[:64]


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple]:
    """(start, end, instance, seed kind or None, patterns): seeds and identifier-like tokens."""
    if "@" not in text and not _DIGIT.search(text):
        return []
    runs = [(None, *run) for run in _digit_runs(text, spans)]
    taken = sorted([*spans, *runs], key=lambda s: (s[1], -s[2]))
    out, reach, recent, i = [], -1, [], 0
    open_rows: list[list] = []  # the last row waits for the word after it
    for start, end in _tokens(text):
        token = text[start:end]
        word = _word(token)
        if open_rows and start >= reach:
            for row in open_rows:
                out.append((*row[:4], _patterns(row[4], word)))
            open_rows = []
        while i < len(taken) and taken[i][1] < end:
            kind, a, b = taken[i]
            if a >= reach:
                open_rows.append([a, b, _instance(text[a:b]), kind, list(recent)])
                reach = max(reach, b)
            i += 1
        if start >= reach:
            inner = token.strip(_EDGE)
            if _looks_identifying(inner):
                a = start + token.index(inner)
                open_rows.append([a, a + len(inner), _instance(inner), None, list(recent)])
                reach = a + len(inner)
        recent = [*recent[-1:], word]
    out += [(*row[:4], _patterns(row[4], "")) for row in open_rows]
    return out


_SCHEMA = (
    "doc_id long, spans array<struct<kind:string,start:long,end:long>>, candidates array<struct<"
    "start:long,end:long,instance:string,kind:string,patterns:array<string>>>"
)


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, spans, candidates) of each whole text, in one pass."""

    def rows_of(rows):
        for doc, raw in rows:
            text = (raw or b"").decode()
            spans = seed_spans(text)
            found = candidates(text, spans)
            yield (
                doc,
                [{"kind": k, "start": a, "end": b} for k, a, b in spans],
                [
                    {"start": a, "end": b, "instance": i, "kind": k, "patterns": p}
                    for a, b, i, k, p in found
                ],
            )

    return map_rows(documents.select("doc_id", "text"), _SCHEMA, rows_of)


def learn_patterns(
    scanned: DataFrame,
    rounds: int | None = ROUNDS,
    min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(pattern, kind, confidence, instances): the accepted patterns after the last round.

    Beliefs and confidences only grow; without a number of rounds they go on until a round adds
    no pattern and the confidences together grow by less than 0.001.
    """
    found = written(
        scanned.select(F.explode("candidates").alias("c"))
        .select(F.explode("c.patterns").alias("pattern"), "c.instance", F.col("c.kind").alias("seed"))
        .groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    )
    # Belief is 1 at most, so a pattern of fewer instances never has the support.
    sizes = written(
        found.groupBy("pattern").agg(F.count("*").alias("instances"))
        .where(F.col("instances") >= min_seeds)
    )
    edges = written(found.join(sizes, "pattern"))
    seeds = written(
        edges.where("seed is not null")
        .select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("belief")).distinct()
    )
    belief, accepted, before = seeds, None, (0, 0.0)
    for _ in count() if rounds is None else range(rounds):
        accepted = written(
            edges.join(belief, "instance").groupBy("pattern", "kind")
            .agg(F.sum("belief").alias("support"), F.max("instances").alias("instances"))
            .withColumn("confidence", F.col("support") / F.col("instances"))
            .where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_seeds))
            .select("pattern", "kind", "confidence", "instances")
        )
        now = accepted.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if now[0] == before[0] and now[1] - before[1] < _SETTLED:
            break
        before = now
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        grown = (
            edges.where("seed is null").drop("instances").join(accepted, "pattern")
            .groupBy("instance", "kind").agg((1 - doubt).alias("belief"))
        )
        belief = written(
            seeds.union(grown).groupBy("instance", "kind").agg(F.max("belief").alias("belief"))
        )
    return accepted


def find_personal_data(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, base, added): spans of the seeds' shapes, and those that patterns add.

    Both are arrays of (kind, start, end), by kind and start; added ones overlap no base span.
    A null or empty text has none. Rows with the same doc_id share what patterns add if their
    texts are equal; columns besides doc_id and text are not looked at.
    """
    scanned = written(scan(documents))
    accepted = learn_patterns(scanned, **options)
    unknown = (
        scanned.select("doc_id", F.explode("candidates").alias("c"))
        .where("c.kind is null")
        .select("doc_id", "c.start", "c.end", F.explode("c.patterns").alias("pattern"))
    )
    best = F.struct("confidence", "kind")
    added = (
        unknown.join(accepted, "pattern")
        .groupBy("doc_id", "start", "end").agg(F.max(best)["kind"].alias("kind"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    return (
        scanned.select("doc_id", F.col("spans").alias("base"))
        .join(added, "doc_id", "left")
        .select("doc_id", "base", F.coalesce(by_kind(F.col("added")), none).alias("added"))
    )


def by_kind(spans: Column) -> Column:
    """Spans in the order of KINDS, then of their starts."""
    order = F.array(*map(F.lit, KINDS))
    ranked = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("rank"),
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.array_sort(ranked),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def masked(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with each span of their text replaced by its kind in brackets.

    documents are (doc_id, text, ...), found is the result of find_personal_data; overlapping
    spans are replaced as one, by the name of the first. Rows keep their other columns.
    """
    spans = (
        found.select("doc_id", F.concat("base", "added").alias("spans"))
        .where(F.size("spans") > 0).dropDuplicates(["doc_id"])
    )
    total = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    if total <= _BROADCAST_SPANS:  # else the texts are shuffled to them
        spans = F.broadcast(spans)
    spans = spans.alias("found")
    joined = documents.alias("own").join(
        spans, F.col("own.doc_id") == F.col("found.doc_id"), "left"
    )
    ordered = F.array_sort(
        F.transform(
            "found.spans",
            lambda s: F.struct(
                s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    text = F.col("own.text")
    state = F.aggregate(
        ordered,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("reach")),
        lambda acc, s: F.when(
            s["start"] >= acc["reach"],
            F.struct(
                F.concat(
                    acc["out"],
                    F.substring(text, acc["reach"] + 1, s["start"] - acc["reach"]),
                    F.lit("["), F.upper(s["kind"]), F.lit("]"),
                ).alias("out"),
                s["end"].alias("reach"),
            ),
        ).otherwise(
            F.struct(
                acc["out"].alias("out"), F.greatest(acc["reach"], s["end"]).alias("reach")
            )
        ),
        lambda acc: F.concat(
            acc["out"], F.substring(text, acc["reach"] + 1, F.length(text))
        ),
    )
    masked_text = F.when(F.col("found.spans").isNull(), text).otherwise(state).alias("text")
    return joined.select(
        *(masked_text if c == "text" else F.col(f"own.`{c}`") for c in documents.columns)
    )
