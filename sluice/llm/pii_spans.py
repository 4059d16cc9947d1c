"""Personal data by patterns and a semi-Markov conditional random field.

Four kinds (email, ip, card, phone) are first found by fixed patterns, kind by
kind. What they miss (a number that runs into its neighbour, a separator they
don't know) is added by a semi-Markov CRF: a segment of tokens is scored as a
whole, by its length in digits, its check sum, its shape and what stands around
it, and dynamic programming over segments of bounded length picks boundaries and
kinds jointly. Pattern spans stay as they are; the CRF reads what is between them.

A segment can be an entity only if it is made of its kind's characters and has a
digit or an @ in it, so the best labelling of a whole text is that of its islands:
runs of such characters. Every island of every whole text is read. The weights
are fitted by gradient ascent on the likelihood of pattern-labelled islands from a
bounded sample of texts (``sample`` of them, by hash of the id).
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import table

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 2000
CARD_DIGITS = (14, 19)
PHONE_DIGITS = (10, 15)
#: Tokens of an entity: a card's digits one by one with a separator between, or a phone's after a + with two.
LONGEST = max(2 * CARD_DIGITS[1] - 1, 3 * PHONE_DIGITS[1] - 1)
EPOCHS = 12
RATE = 0.3
DECAY = 1e-4
REMEMBERED = 100_000
PART = 200

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER_CHARS = " ().+-"
_LOCAL_CHARS = re.compile(r"[A-Za-z0-9._%+@-]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        d = _digits(found)
        return CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and luhn(d)
    if kind == "phone":
        return PHONE_DIGITS[0] <= len(_digits(found)) <= PHONE_DIGITS[1]
    return True


def islands(text: str) -> list[tuple[int, int]]:
    """Merged half-open runs of the text that can hold personal data, in order."""
    runs = []
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start and _LOCAL_CHARS.match(text[start - 1]):
            start -= 1
        while end < len(text) and _LOCAL_CHARS.match(text[end]):
            end += 1
        runs.append((start, end))
        at = text.find("@", end)
    for m in re.finditer(r"[0-9][ ().0-9+-]*", text):
        start = m.start()
        while start and text[start - 1] in _NUMBER_CHARS:
            start -= 1
        runs.append((start, m.end()))
    runs.sort()
    out: list[tuple[int, int]] = []
    for s, e in runs:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """Pattern spans of a text: (kind, start, end), ordered by start, then kind as listed.

    A pattern's matches lie within runs of its own characters, so only those are searched.
    """
    out = []
    for s, e in islands(text) if runs is None else runs:
        part = text[s:e]
        if "@" in part:
            for run in re.finditer(r"[A-Za-z0-9._%+@-]+", part):
                if "@" in run.group():
                    out += [("email", s + run.start() + m.start(), s + run.start() + m.end()) for m in _EMAIL.finditer(run.group())]
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in part or kind == "ip" and part.count(".") < 3:
                continue
            out += [(kind, s + m.start(), s + m.end()) for m in pattern.finditer(part) if _valid(kind, m.group())]
    return sorted(out, key=_span_order)


def _span_order(span):
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_CHARS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]*[A-Za-z0-9]\Z"),
    "ip": re.compile(r"[0-9][0-9.]*\.[0-9.]*[0-9]\Z"),
    "card": re.compile(r"[0-9][0-9 .-]*[0-9]\Z"),
    "phone": re.compile(r"[+(0-9][0-9 ().+-]*[0-9]\Z"),
}


def _around(c: str) -> str:
    if not c:
        return "edge"
    if c.isalnum():
        return "digit" if c.isdigit() else "letter"
    return c if c in "@.+-()" else "space" if c.isspace() else "mark"


def segment_features(kind: str, text: str, before: str, after: str) -> list[str] | None:
    """Whole-span features of a segment as ``kind``, or None where it cannot be one."""
    if not _CHARS[kind].match(text):
        return None
    shape = re.sub(r"[0-9]+", lambda m: f"<{len(m.group())}>", text)
    shape = re.sub(r"[A-Za-z]+", "a", shape)
    if kind == "email":
        shape = re.sub(r"<[0-9]+>|a", "a", shape)
        shape = re.sub(r"a+", "a", shape)
        facts = [f"ats{text.count('@')}", f"dots{min(3, text.split('@', 1)[1].count('.'))}", f"host-ok{bool(_EMAIL.fullmatch(text))}"]
    else:
        digits = _digits(text)
        facts = [f"digits{min(len(digits), 24)}"]
        if kind == "ip":
            parts = text.split(".")
            facts.append(f"parts{min(len(parts), 6)}")
            facts.append(f"bytes{all(p and len(p) <= 3 and int(p) <= 255 for p in parts)}")
        elif kind == "card":
            facts.append(f"check{14 <= len(digits) <= 19 and luhn(digits)}")
            facts.append(f"even{len({len(g) for g in re.findall('[0-9]+', text)}) == 1}")
        else:
            facts.append(f"plus{text.count('+') if text[0] == '+' else 'no'}")
            facts.append(f"length-ok{text[0] == '+' and 10 <= len(digits) <= 15}")
            facts.append(f"round{text.count('(') == text.count(')')}")
    return [f"{kind}|{f}" for f in ("any", "shape" + shape, f"before-{_around(before)}", f"after-{_around(after)}", *facts)]


#: Kinds whose segments may hold a letter ("a") or a character; digits are in all.
_MAY_HOLD = {
    "a": {"email"}, "@": {"email"}, "_": {"email"}, "%": {"email"}, "+": {"email", "phone"}, "-": {"email", "card", "phone"},
    ".": set(KINDS), " ": {"card", "phone"}, "(": {"phone"}, ")": {"phone"},
}


class SpanModel:
    """A semi-Markov CRF: log-linear scores of segments; a token outside all entities scores 0."""

    def __init__(self, weights: dict[str, float] | None = None, longest: int = LONGEST):
        self.weights, self.longest = weights or {}, longest
        self.seen: dict[tuple[str, str, str], list] = {}
        self.scores: dict[tuple, float | None] = {}
        self.bounds: dict[tuple, float] = {}

    def _segments(self, text: str, before: str, after: str):
        """Token bounds and candidate segments by end: (first token, kind, features)."""
        bounds = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
        ends = defaultdict(list)
        for i in range(len(bounds) - 1):
            first = text[bounds[i]]
            if not (first.isalnum() or first in "+(._%-"):
                continue
            for j in range(i + 1, min(len(bounds), i + 1 + self.longest)):
                s, e = bounds[i], bounds[j]
                if not text[e - 1].isalnum():
                    continue
                inside = text[s:e]
                left = text[s - 1] if s else before
                right = text[e] if e < len(text) else after
                for kind in KINDS:
                    if ("@" in inside) != (kind == "email"):
                        continue
                    features = segment_features(kind, inside, left, right)
                    if features is not None:
                        ends[j].append((i, kind, features))
        return bounds, ends

    def _score(self, features: list[str]) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in features)

    def decode(self, text: str, before: str = "", after: str = "") -> list[tuple[str, int, int]]:
        """The best joint choice of entities of an island: (kind, start, end)."""
        key = (text, _around(before), _around(after))
        found = self.seen.get(key)
        if found is not None:
            return found
        bounds = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
        best, back = [0.0] * len(bounds), [None] * len(bounds)
        arriving: dict[int, list] = {}  # segments by end, of the ends within reach only
        for j in range(len(bounds)):
            if j:
                best[j] = best[j - 1]
            for s, i, kind in arriving.pop(j, ()):
                if s > best[j] + 1e-12:
                    best[j], back[j] = s, (i, kind)
            for end, kind, score in self._from(text, bounds, j, before, after):
                arriving.setdefault(end, []).append((best[j] + score, j, kind))
        out, j = [], len(bounds) - 1
        while j:
            if back[j]:
                i, kind = back[j]
                out.append((kind, bounds[i], bounds[j]))
                j = i
            else:
                j -= 1
        out.reverse()
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        if len(text) <= 64:
            self.seen[key] = out
        return out

    def _from(self, text: str, bounds: list[int], i: int, before: str, after: str):
        """(end token, kind, score) of the segments from token ``i`` that can score above 0.

        A segment of no positive score is never part of the best choice, and a bound from
        its number of digits settles most of those before their features are made.
        """
        if i == len(bounds) - 1:
            return
        s = bounds[i]
        first = text[s]
        if not (first.isalnum() or first in "+(._%-"):
            return
        open_, digits, email = set(KINDS), 0, False
        left = _around(text[s - 1] if s else before)
        for j in range(i + 1, min(len(bounds), i + 1 + self.longest)):
            e = bounds[j]
            token = text[bounds[j - 1] : e]
            if "0" <= token[0] <= "9":
                digits += len(token)
            else:
                email = email or token == "@"
                open_ &= _MAY_HOLD.get("a" if len(token) > 1 or "A" <= token <= "Z" or "a" <= token <= "z" else token, set())
                if not open_:
                    return
            if not text[e - 1].isalnum():
                continue
            right = _around(text[e] if e < len(text) else after)
            for kind in KINDS:
                if kind not in open_ or (kind == "email") != email or self._most(kind, digits, first) <= 0:
                    continue
                key = (kind, text[s:e], left, right)
                score = self.scores.get(key, key)
                if score is key:
                    features = segment_features(kind, text[s:e], text[s - 1] if s else before, text[e] if e < len(text) else after)
                    score = None if features is None else self._score(features)
                    if len(self.scores) >= REMEMBERED:
                        self.scores.clear()
                    if e - s <= 96:
                        self.scores[key] = score
                if score is not None and score > 0:
                    yield j, kind, score

    def _most(self, kind: str, digits: int, first: str) -> float:
        """No segment of this kind with so many digits and this first character scores more."""
        if kind in ("email", "ip"):
            return math.inf
        key = (kind, digits, first == "+")
        known = self.bounds.get(key)
        if known is None:
            w = self.weights

            def most(start: str) -> float:
                return max([0.0] + [v for f, v in w.items() if f.startswith(f"{kind}|{start}")])

            known = w.get(f"{kind}|any", 0.0) + w.get(f"{kind}|digits{min(digits, 24)}", 0.0)
            known += most("shape") + most("before-") + most("after-")
            if kind == "card":
                fits = CARD_DIGITS[0] <= digits <= CARD_DIGITS[1]
                known += (most("check") if fits else w.get("card|checkFalse", 0.0)) + most("even")
            else:
                fits = first == "+" and PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1]
                known += w.get(f"phone|length-ok{fits}", 0.0) + most("round")
                known += most("plus") if first == "+" else w.get("phone|plusno", 0.0)
            self.bounds[key] = known
        return known

    def gradient(self, text: str, before: str, after: str, gold: list[tuple[str, int, int]], prepared=None):
        """(log likelihood, gradient by feature) of one labelled island."""
        bounds, ends = prepared or self._segments(text, before, after)
        n = len(bounds)
        scored = {j: [(i, kind, f, self._score(f)) for i, kind, f in segs] for j, segs in ends.items()}
        forward = [0.0] * n
        for j in range(1, n):
            forward[j] = _log_sum([forward[j - 1]] + [forward[i] + s for i, _, _, s in scored.get(j, ())])
        backward = [0.0] * n
        begins = defaultdict(list)
        for j, segs in scored.items():
            for i, _, _, s in segs:
                begins[i].append((j, s))
        for i in range(n - 2, -1, -1):
            backward[i] = _log_sum([backward[i + 1]] + [backward[j] + s for j, s in begins[i]])
        total = forward[-1]
        want = {(s, e, k) for k, s, e in gold}
        grad: dict[str, float] = defaultdict(float)
        likely = -total
        for j, segs in scored.items():
            for i, kind, features, s in segs:
                p = math.exp(forward[i] + s + backward[j] - total)
                hit = (bounds[i], bounds[j], kind) in want
                likely += s if hit else 0.0
                for f in features:
                    grad[f] += hit - p
        return likely, grad


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def pieces_between(text: str, runs, base) -> list[tuple[int, int]]:
    """What is left of the islands between pattern spans, as half-open spans that hold a digit or an @."""
    out = []
    taken = sorted((s, e) for _, s, e in base)
    k = 0
    for s, e in runs:
        at, free = s, []
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        t = k
        while t < len(taken) and taken[t][0] < e:
            if taken[t][0] > at:
                free.append((at, taken[t][0]))
            at = max(at, taken[t][1])
            t += 1
        if at < e:
            free.append((at, e))
        out += [(a, b) for a, b in free if "@" in text[a:b] or any("0" <= c <= "9" for c in text[a:b])]
    return out


def training_parts(text: str, start: int, end: int, gold: list[tuple[str, int, int]]):
    """An island in parts of about ``PART`` characters, none cut within an entity: (start, end, entities)."""
    at = start
    while at < end:
        to = min(end, at + PART)
        if to < end:
            space = text.rfind(" ", at + 1, to)
            to = space if space > at else to
            to = max([to] + [b for _, a, b in gold if a < to < b])
        yield at, to, [(k, a - at, b - at) for k, a, b in gold if at <= a and b <= to]
        at = to


def find_spans(text: str, model: SpanModel):
    """(pattern spans, spans that the model adds) of a whole text."""
    runs = islands(text)
    if not runs:
        return [], []
    base = base_spans(text, runs)
    added = []
    for s, e in pieces_between(text, runs, base):
        before, after = text[s - 1] if s else "", text[e] if e < len(text) else ""
        added += [(kind, s + a, s + b) for kind, a, b in model.decode(text[s:e], before, after)]
    return base, added


def fit_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, epochs: int = EPOCHS) -> SpanModel:
    """A model fitted on the islands of the texts of at most ``sample`` ids that hold a digit or an @.

    Islands are labelled by the patterns (overlapping ones: the first); equal
    labelled islands, long ones in parts, are counted; at most ``sample`` different ones
    are used, chosen by hash and in turn from every pattern of kinds (none included).
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = rows.where(F.col("t").rlike("[0-9@]"))
    # ids are ordered, not texts: at most ``sample`` of them go to all tasks
    ids = rows.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = rows.join(F.broadcast(ids), "id", "left_semi")

    def label(batches):
        for batch in batches:
            out = Counter()
            for text in batch.column("t").to_pylist():
                runs = islands(text)
                base = base_spans(text, runs)
                for s, e in runs:
                    gold, at = [], s
                    for kind, a, b in base:
                        if at <= a and b <= e:
                            gold.append((kind, a, b))
                            at = b
                    for a, b, inside in training_parts(text, s, e, gold):
                        out[text[a - 1 : a] if a else "", text[a:b], text[b : b + 1], joined(inside)] += 1
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.string()) for i in range(4)] + [pa.array([out[k] for k in keys], pa.int64())],
                names=["before", "text", "after", "gold", "n"],
            )

    # the first of every pattern by hash, then the second of every pattern, ...: no kind is crowded out
    of_pattern = Window.partitionBy("pattern").orderBy(F.xxhash64("text", "before", "after"), "text", "before", "after")
    found = (
        rows.mapInArrow(label, "before string, text string, after string, gold string, n long")
        .groupBy("before", "text", "after", "gold").agg(F.sum("n").alias("n"))
        .withColumn("pattern", F.array_join(F.array_distinct(F.regexp_extract_all("gold", F.lit("[a-z]+"), F.lit(0))), "+"))
        .withColumn("nth", F.row_number().over(of_pattern)).where(F.col("nth") <= sample)
        .orderBy("nth", "pattern").limit(sample).collect()
    )
    model = SpanModel()
    data = []
    for r in found:
        gold = [(k, int(s), int(e)) for k, s, e in (g.split(":") for g in r["gold"].split(",") if g)]
        data.append((r["n"], gold, model._segments(r["text"], r["before"], r["after"])))
    square: dict[str, float] = defaultdict(lambda: 1e-8)
    for _ in range(epochs):
        for n, gold, prepared in data:
            _, grad = model.gradient("", "", "", gold, prepared)
            for f, g in grad.items():
                g = g * min(n, 10) - DECAY * model.weights.get(f, 0.0)
                square[f] += g * g
                model.weights[f] = model.weights.get(f, 0.0) + RATE * g / math.sqrt(square[f])
    return model


def find_pii(docs: DataFrame, model: SpanModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base and spans as arrays of (kind, start, end).

    ``base`` holds the pattern spans, ``spans`` these and the model's, both by start,
    then kind as listed; positions are code points, ends exclusive. Null and empty
    texts have none; long ones are decoded with the segments within reach in memory,
    in time proportional to their length. Without a model one is fitted on ``docs``. Repeated rows and
    null ids give a row each; an empty table gives no rows; other columns are ignored.
    """
    weights = (model or fit_model(docs, id_col, text_col)).weights
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def search(batches):
        finder = SpanModel(weights)
        for batch in batches:
            base, spans = [], []
            for text in batch.column("t").to_pylist():
                found, added = find_spans(text, finder)
                base.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in found])
                spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in sorted(found + added, key=_span_order)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(base, spans_type), pa.array(spans, spans_type)], names=["id", "base", "spans"]
            )

    listed = "array<struct<kind: string, start: int, end: int>>"
    return rows.mapInArrow(search, f"id {kind}, base {listed}, spans {listed}").withColumnRenamed("id", id_col)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the contract; n_email to n_phone count the pattern spans, n_added the model's."""
    found = find_pii(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS),
        F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
