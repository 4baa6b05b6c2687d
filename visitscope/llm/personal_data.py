"""Personal data by fixed patterns and a semi-Markov conditional random field.

Base spans are the leftmost non-overlapping matches of one pattern for each
kind (email, ip, card, phone) that pass their check; a match that fails is
dropped and not tried again. So a phone number beside a card number, which one
greedy match swallows, is lost to them, and so is every other way of writing.

The field finds those. Around each digit, at-sign and written-out "at" or
"dot" it takes a region of text, cuts it into runs of digits, runs of letters
and single signs, and lists candidate segments of at most `LONGEST` such tokens
and of one kind. Features look at a whole candidate: its check digit, octets,
groups of digits, brackets, what stands before and after it. Viterbi over
(token, kind of the last segment) picks the segments that do not overlap, all
boundaries and kinds at once; tokens outside are segments of their own without
a score. Its spans are added to the base ones, which stay, also where they
overlap.

Weights maximise the conditional likelihood (forward-backward over segments) of
`EXAMPLES` made regions: spans that the patterns find alone in a region, at
most `BANK` a kind by a hash, and other chunks with digits from the same texts,
put side by side as they stand in a list, also rewritten (no plus sign, another
grouping, at and dot written out) or spoilt (another check digit, an octet over
255), beside dates, versions and numbers. A kind without a base span anywhere
has nothing to learn from and gets no spans beyond them.

On Spark: one map over the texts writes base spans and regions (a few bytes a
text) to the shared folder, the bank is a window function over them, and a
second map over that table decodes. No shuffle of texts; no text reaches the
driver but the bank's bounded chunks.

Defined results: null text is empty; rows are taken each for itself, so null
and repeated ids stay; positions are code points, ends exclusive; spans are
sorted by start, then kind as listed, then end; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches, staged, text_or_empty, texts

KINDS = ("email", "ip", "card", "phone")
LONGEST = 39        # tokens of a candidate: 19 digits with a sign between each two
BANK = 200          # base spans a kind, and other chunks, that are learnt from
EXAMPLES = 500      # made regions
EPOCHS = 8
CONTEXT = 24        # characters before a region that features see
SPAN = "array<struct<kind:string,start:int,end:int>>"

# Base patterns --------------------------------------------------------------

# A match never starts amid a run of digits: one that started at the run's
# beginning went through its end, or failed for what follows the run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right counts doubled, its digits added."""
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every base span, sorted."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGITS.sub("", m.group())) <= 15]
    return sorted(found)


# Regions and candidates -----------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]")
_WRITTEN = re.compile(r"(?i)[\[({] ?(?:at|dot) ?[\])}]| dot (?=[a-z0-9])")
_SPACES = " \n\t\r\x0b\x0c"
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]", re.S)
_AT = r"(?:@| ?[\[({] ?(?:at|AT) ?[\])}] ?| at )"
_DOT = r"(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?| dot )"
_ANY_EMAIL = re.compile(rf"([A-Za-z0-9._%+-]++){_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++")
_LABEL_END = re.compile(rf"(?={_DOT})")
_JOINT = re.compile(rf"{_AT}|{_DOT}")
_ANY_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")


def regions(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs of words, one white space apart, that hold a digit or at-sign, or an "at" or "dot" in signs."""
    found: list[list[int]] = []
    lo, pos = 0, 0
    while (hit := _TRIGGER.search(text, pos)) is not None:
        start = max(text.rfind(c, lo, hit.start()) for c in _SPACES) + 1
        start = max(start, lo)
        space = _SPACE.search(text, hit.end())
        end = space.start() if space else len(text)
        if found and start == found[-1][1] + 1:
            found[-1][1] = end
        else:
            found.append([start, end])
        lo = pos = end
    written = []
    for m in _WRITTEN.finditer(text):
        a, b = max(0, m.start() - 90), min(len(text), m.end() + 90)
        written.append([max(a, text.rfind("\n", a, m.start()) + 1), text.find("\n", m.end(), b) if "\n" in text[m.end():b] else b])
    out: list[list[int]] = []
    for start, end in sorted(found + written):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


@dataclass
class Region:
    text: str
    left: str                                    # what stands before it
    edges: list[int]                             # where tokens begin, and the end
    candidates: list[tuple[int, int, int]]       # (first token, token after, number of the kind)


def read_region(text: str, left: str) -> Region:
    edges = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
    token_at = {p: k for k, p in enumerate(edges)}
    found = []
    n = len(edges) - 1
    for i in range(n):
        first = text[edges[i]]
        digit = "0" <= first <= "9"
        if (digit or first.isascii() and first.isalpha()) and not (edges[i] and text[edges[i] - 1] in _LOCAL_SIGNS):
            m = _ANY_EMAIL.match(text, edges[i])
            if m and not (" at " in m.group() and " dot " not in m.group()):
                joints = [j.start() for j in _JOINT.finditer(text, m.end(1), m.end())][2:] + [m.end()]
                found += [(i, token_at[e], 0) for e in joints if e in token_at and token_at[e] - i <= LONGEST]
        if digit:
            m = _ANY_IP.match(text, edges[i])
            if m:
                found.append((i, token_at[m.end()], 1))
        if digit or first == "(" or first == "+":
            digits = gap = 0
            card = phone = True
            for j in range(i, min(n, i + LONGEST)):
                token = text[edges[j]:edges[j + 1]]
                if "0" <= token[0] <= "9":
                    digits, gap = digits + len(token), 0
                    if digits > 19:
                        break
                    if card and digit and 13 <= digits:
                        found.append((i, j + 1, 2))
                    if phone and 7 <= digits <= 15:
                        found.append((i, j + 1, 3))
                    continue
                gap += 1
                card &= gap == 1 and token in " -"
                phone &= token in " ().-" and gap <= 3 or token == "+" and j == i
                if not (card or phone):
                    break
    return Region(text, left, edges, found)


# Features -------------------------------------------------------------------

# Words that announce a kind, in the four languages.
CUES = {0: ("mail", "correo", "kontakt", "contact"), 1: ("ip", "host", "server", "servidor", "serveur"),
        2: ("card", "karte", "carte", "tarjeta", "visa"), 3: ("tel", "phone", "call", "fax", "ruf", "mobil", "llam")}


def features(region: Region, i: int, j: int, kind: int) -> list[str]:
    """Names of the features that a whole candidate has."""
    a, b = region.edges[i], region.edges[j]
    text, span = region.text, region.text[a:b]
    before = text[a - 1] if a else region.left[-1:]
    after, beyond = text[b:b + 1], text[b + 1:b + 2]
    on = ["bias"]
    if before.isalnum() or before in ("@", "_", "%", "#", "="):
        on.append("joined before")
    elif before in (".", "-", "+", "/", ":", ",") and (text[a - 2:a - 1] if a > 1 else region.left[-2:-1]).isalnum():
        on.append("sign before")
    if after.isalnum() or after in ("@", "_", "%"):
        on.append("joined after")
    elif after and after in ".-/:," and beyond.isalnum():
        on.append("sign after")
    said = (region.left + text[:a])[-CONTEXT:].lower()
    if any(c in said for c in CUES[kind]):
        on.append("cue")
    if kind == 0:
        parts = [p for p in _JOINT.split(span) if p]
        on.append("plain" if "@" in span and " " not in span and "[" not in span and "(" not in span else "written out")
        if parts and parts[-1].isalpha() and 2 <= len(parts[-1]) <= 8:
            on.append("top label")
        if any(p.startswith("-") or p.endswith("-") for p in parts[1:]):
            on.append("bad label")
        return on
    digits = _NOT_DIGITS.sub("", span)
    if kind == 1:
        parts = span.split(".")
        on.append("octets" if octets(span) else "no octets")
        if any(len(p) > 1 and p[0] == "0" for p in parts) or parts[0] == "0":
            on.append("leading zero")
        return on
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    signs = set(span) - set("0123456789")
    if kind == 2:
        on.append("luhn" if luhn(digits) else "no luhn")
        on.append(f"{len(digits)} digits" if len(digits) <= 16 else "over 16 digits")
        on.append("one group" if len(groups) == 1 else "fours" if set(groups[:-1]) == {4} and groups[-1] <= 4 else "other groups")
        on.append("card start" if digits[0] in "3456" else "other start")
        if len(signs) > 1:
            on.append("mixed signs")
        return on
    n = len(digits)
    on.append("plus" if span[0] == "+" else "bracket" if span[0] == "(" else "double zero" if digits[:2] == "00" else "no prefix")
    on.append("under 10" if n < 10 else f"{n} digits" if n <= 12 else "over 12")
    national = groups[-3:] == [3, 3, 4]
    on.append("3-3-4" if national else "one group" if len(groups) == 1 else "other groups")
    known = "3-3-4 alone" if groups == [3, 3, 4] else "with country" if national and len(groups) == 4 and groups[0] <= 3 else "other form"
    on.append(known)
    if len(groups) > 5 or max(groups) > 11:
        on.append("odd groups")
    if span.count("(") != span.count(")"):
        on.append("unbalanced")
    if "." in signs and len(signs) > 1:
        on.append("mixed dots")
    if known == "other form" and span[0] != "+":
        on.append("bare")
    return on


# The field ------------------------------------------------------------------

LABELS = len(KINDS) + 1  # 0 is a token outside


@dataclass
class Field:
    """Weights of features by kind, and of a kind after another (0: outside)."""

    weights: dict[tuple[int, str], float]
    follows: np.ndarray

    def scores(self, region: Region) -> list[float]:
        return [sum(self.weights.get((k, f), -1.0 if f == "bias" else 0.0) for f in features(region, i, j, k))
                for i, j, k in region.candidates]

    def decode(self, region: Region) -> list[tuple[int, int, int]]:
        """The best segments as (start, number of the kind, end)."""
        if not region.candidates:
            return []
        n = len(region.edges) - 1
        best = np.full((n + 1, LABELS), -np.inf)
        back: list[list[tuple[int, int] | None]] = [[None] * LABELS for _ in range(n + 1)]
        best[0, 0] = 0.0
        ending: dict[int, list[tuple[int, int, float]]] = {}
        for (i, j, k), s in zip(region.candidates, self.scores(region), strict=True):
            ending.setdefault(j, []).append((i, k + 1, s))
        for j in range(1, n + 1):
            for i, label, s in [(j - 1, 0, 0.0), *ending.get(j, ())]:
                ways = best[i] + self.follows[:, label]
                last = int(ways.argmax())
                if ways[last] + s > best[j, label]:
                    best[j, label] = ways[last] + s
                    back[j][label] = (i, last)
        found, j, label = [], n, int(best[n].argmax())
        while j:
            i, last = back[j][label]
            if label:
                found.append((region.edges[i], label - 1, region.edges[j]))
            j, label = i, last
        return found[::-1]


def _log_sum(values: np.ndarray) -> float:
    top = values.max()
    return -math.inf if top == -math.inf else float(top + np.log(np.exp(values - top).sum()))


def fit(examples: list[tuple[Region, set[tuple[int, int, int]]]], kinds: set[int]) -> Field:
    """Weights by AdaGrad on the log-likelihood of each example's segments (first token, token after, kind)."""
    names: dict[tuple[int, str], int] = {}
    rows = []
    for region, gold in examples:
        region.candidates = [c for c in region.candidates if c[2] in kinds]
        on = [[names.setdefault((k, f), len(names)) for f in features(region, i, j, k)] for i, j, k in region.candidates]
        rows.append((region, gold, on))
    weights, follows = np.zeros(len(names)), np.zeros((LABELS, LABELS))
    seen_w, seen_f = np.full(len(names), 1e-2), np.full((LABELS, LABELS), 1e-2)
    for _ in range(EPOCHS):
        for region, gold, on in rows:
            n = len(region.edges) - 1
            ending = [[(j - 1, 0, 0.0, -1)] for j in range(n + 1)]
            for at, ((i, j, k), f) in enumerate(zip(region.candidates, on, strict=True)):
                ending[j].append((i, k + 1, float(weights[f].sum()), at))
            ahead = np.full((n + 1, LABELS), -np.inf)
            ahead[0, 0] = 0.0
            for j in range(1, n + 1):
                for i, label, s, _at in ending[j]:
                    ahead[j, label] = np.logaddexp(ahead[j, label], _log_sum(ahead[i] + follows[:, label]) + s)
            behind = np.full((n + 1, LABELS), -np.inf)
            behind[n] = 0.0
            for j in range(n, 0, -1):
                for i, label, s, _at in ending[j]:
                    behind[i] = np.logaddexp(behind[i], follows[:, label] + s + behind[j, label])
            total = _log_sum(ahead[n])
            up_w, up_f = np.zeros(len(names)), np.zeros((LABELS, LABELS))
            path = _gold_path(n, gold)
            for j in range(1, n + 1):
                for i, label, s, at in ending[j]:
                    share = np.exp(ahead[i] + follows[:, label] + s + behind[j, label] - total)
                    up_f[:, label] -= share
                    if at >= 0:
                        up_w[on[at]] -= share.sum()
            place = {c: at for at, c in enumerate(region.candidates)}
            last = 0
            for i, j, label in path:
                up_f[last, label] += 1
                if label:
                    up_w[on[place[i, j, label - 1]]] += 1
                last = label
            up_w -= 1e-3 * weights
            up_f -= 1e-3 * follows
            seen_w += up_w ** 2
            seen_f += up_f ** 2
            weights += 0.5 * up_w / np.sqrt(seen_w)
            follows += 0.5 * up_f / np.sqrt(seen_f)
    learnt = {name: float(weights[at]) for name, at in names.items()}
    for k in range(len(KINDS)):
        if k not in kinds:
            learnt[k, "bias"] = -math.inf
    return Field(learnt, follows)


def _gold_path(n: int, gold: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    begins = {i: (j, k) for i, j, k in gold}
    path, at = [], 0
    while at < n:
        j, k = begins.get(at, (at + 1, -1))
        path.append((at, j, k + 1))
        at = j
    return path


# Examples -------------------------------------------------------------------

def _other_forms(rnd: random.Random, kind: int, span: str) -> tuple[str, bool]:
    """The span as it is, rewritten, or (False) spoilt."""
    digits = _NOT_DIGITS.sub("", span)
    way = rnd.random()
    if kind == 0 and way < 0.3:
        at, dot = rnd.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."), (" [at] ", ".")])
        local, domain = span.split("@")
        return local + at + domain.replace(".", dot), True
    if kind == 1 and way < 0.2:
        parts = span.split(".")
        parts[rnd.randrange(4)] = str(rnd.randint(256, 999))
        return ".".join(parts), False
    if kind == 2 and way < 0.5:
        if way < 0.25:
            last = str((int(digits[-1]) + rnd.randint(1, 9)) % 10)
            return digits[:-1] + last, False
        sign = rnd.choice(" -")
        return sign.join(digits[k:k + 4] for k in range(0, len(digits), 4)), True
    if kind == 3 and way < 0.6 and len(digits) >= 10:
        a, b, c, country = digits[-10:-7], digits[-7:-4], digits[-4:], digits[:-10]
        return rnd.choice([(f"({a}) {b}-{c}", True), (f"{a}-{b}-{c}", True), (f"{a}.{b}.{c}", True), (f"+{country or 1} {a} {b} {c}", True),
                           (f"+{country or 1}-{a}-{b}-{c}", True), (f"({a}){b}-{c}", True), (f"{a}{b}{c}", False)])
    return span, True


def _plain_number(rnd: random.Random) -> str:
    """Digits that are no personal data: dates, versions, times, amounts, codes."""
    def n(size: int) -> str:
        return "".join(rnd.choice("0123456789") for _ in range(size))

    long = n(rnd.randint(8, 19))
    if luhn(long):
        long = long[:-1] + str((int(long[-1]) + 1) % 10)
    return rnd.choice([long, n(4), n(rnd.randint(1, 7)), f"20{n(2)}-0{rnd.randint(1, 9)}-1{n(1)}", f"1{n(1)}.0{rnd.randint(1, 9)}.20{n(2)}",
                       f"{rnd.randint(1, 9)}.{n(1)}", f"v{n(1)}.{n(2)}.{n(1)}", f"1{n(1)}:{n(2)}:{n(2)}", f"{n(2)},{n(3)}.{n(2)}",
                       f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{n(3)}-{n(3)}", f"{n(3)}-{n(2)}-{n(4)}", f"({n(4)})", f"§{n(2)}",
                       f"{n(2)}.{n(2)}.{n(2)}.{n(2)}.{n(2)}", f"{n(5)}-{n(4)}"])


def examples(bank: list[tuple[str, str]], seed: int = 11) -> list[tuple[Region, set[tuple[int, int, int]]]]:
    """Made regions of one to three chunks side by side, and where their segments are."""
    rnd = random.Random(seed)
    by_kind = {k: sorted({t for kind, t in bank if kind == name}) for k, name in enumerate(KINDS)}
    known = [k for k, spans in by_kind.items() if spans]
    others = sorted({t for kind, t in bank if kind == "other"})
    out = []
    while known and len(out) < EXAMPLES:
        text, gold = "", []
        for _ in range(rnd.choice([1, 1, 2, 2, 3])):
            if text:
                text += rnd.choice([" ", " ", " ", "\n", ", ", " | "])
            what = rnd.random()
            if what < 0.65:
                kind = rnd.choice(known)
                span, real = _other_forms(rnd, kind, rnd.choice(by_kind[kind]))
                if real:
                    gold.append((len(text), len(text) + len(span), kind))
                text += span + rnd.choice(["", "", ".", ",", "!!", "###"])
            elif what < 0.8 and others:
                text += rnd.choice(others)
            else:
                text += _plain_number(rnd)
        region = read_region(text, rnd.choice(["and the ", "é ", "| ", "", "x\n"]))
        token_at = {p: k for k, p in enumerate(region.edges)}
        marked = {(token_at.get(a), token_at.get(b), k) for a, b, k in gold}
        if marked <= set(region.candidates):
            out.append((region, marked))
    return out


# Spark -----------------------------------------------------------------------

def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    base, near = [], []
    for text in texts(batch.column("text")):
        base.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in base_spans(text)])
        near.append([{"start": a, "text": text[a:b], "left": text[max(0, a - CONTEXT):a]} for a, b in regions(text)])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    region = pa.list_(pa.struct([("start", pa.int32()), ("text", pa.string()), ("left", pa.string())]))
    return pa.record_batch([batch.column("doc_id"), pa.array(base, span), pa.array(near, region)], names=["doc_id", "base", "near"])


def _chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(kind, text) of base spans that stand alone in their region, and of regions without one."""
    kinds, found = [], []
    for base, near in zip(batch.column("base").to_pylist(), batch.column("near").to_pylist(), strict=True):
        for r in near:
            a, b = r["start"], r["start"] + len(r["text"])
            inside = [s for s in base if s["start"] < b and s["end"] > a]
            if len(r["text"]) > 120 or len(inside) > 1:
                continue
            if inside and inside[0]["start"] >= a and inside[0]["end"] <= b:
                s = inside[0]
                rest = r["text"][:s["start"] - a] + r["text"][s["end"] - a:]
                if not _TRIGGER.search(rest):
                    kinds.append(s["kind"])
                    found.append(r["text"][s["start"] - a:s["end"] - a])
            elif not inside and not read_region(r["text"], r["left"]).candidates:
                kinds.append("other")
                found.append(r["text"])
    return pa.record_batch([pa.array(kinds, pa.string()), pa.array(found, pa.string())], names=["kind", "text"])


def learn(scanned: DataFrame) -> Field:
    """The field, from at most `BANK` chunks a kind, which are all that reaches the driver."""
    chunks = map_batches(scanned, _chunks, "kind string, text string").distinct()
    first = Window.partitionBy("kind").orderBy("h", "text")
    bank = (chunks.withColumn("h", F.xxhash64("text")).withColumn("nth", F.row_number().over(first))
            .where(F.col("nth") <= BANK).select("kind", "text").collect())
    pairs = [(r["kind"], r["text"]) for r in bank]
    return fit(examples(pairs), {k for k, name in enumerate(KINDS) if any(kind == name for kind, _ in pairs)})


def find(documents: DataFrame) -> DataFrame:
    """(doc_id, base, added) of every document, both arrays of (kind, start, end)."""
    small_batches(documents.sparkSession)
    scanned = staged(map_batches(documents.select("doc_id", text_or_empty("text").alias("text")), _scan,
                                 f"doc_id long, base {SPAN}, near array<struct<start:int,text:string,left:string>>"), "personal-data")
    field = learn(scanned)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = []
            for base, near in zip(batch.column("base").to_pylist(), batch.column("near").to_pylist(), strict=True):
                known = {(s["start"], s["kind"], s["end"]) for s in base}
                spans = [(r["start"] + a, KINDS[k], r["start"] + b) for r in near
                         for a, k, b in field.decode(read_region(r["text"], r["left"]))]
                added.append([{"kind": k, "start": a, "end": b} for a, k, b in spans if (a, k, b) not in known])
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.record_batch([batch.column("doc_id"), batch.column("base"), pa.array(added, span)], names=["doc_id", "base", "added"])

    return scanned.mapInArrow(decode, f"doc_id long, base {SPAN}, added {SPAN}")


def span_text(spans):
    """`kind:start:end` of an array of spans by start, then kind as listed, then end, comma-joined."""
    order = F.array(*(F.lit(k) for k in KINDS))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"),
                                                               s["end"].alias("b"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts are of base spans."""
    found = find(documents)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_text("base"), 256).alias("base_sha256"),
                        span_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
