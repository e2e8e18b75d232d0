"""Personal data: generators, boosted trees over candidates, calibrated thresholds.

1. High-recall generators propose spans, which may overlap: every match of the four base
   patterns; looser ones for phone numbers without a plus sign, national numbers, bank
   accounts and secrets (access tokens, keys, and the value of an assignment by itself);
   and, inside each run of digit groups, every sequence of groups that could be a card (its
   checksum holds), a phone number or an address, so items that stand in rows and tables
   are proposed one by one as well as together.
2. Boosted trees (numpy, logistic loss, binned features) score each candidate by its
   format (lengths, character classes, groups, checksums, entropy) and its context (the
   words and marks before it, the characters around it).
3. Scores are calibrated on candidates held back from the training (Platt scaling), and
   each kind has the lowest threshold with ``PRECISION`` on them.
4. Base spans (the patterns whose checks pass) stay in any case. An added span stays when it
   reaches its threshold and overlaps neither a base span nor a better added one.

Training uses the candidates of ``SYNTHETIC`` texts drawn from seeded rules, plus those of at
most about ``SAMPLE_DOCS`` documents, chosen by a hash of id and text, at most
``SAMPLE_CANDIDATES`` of each (those with the smallest hashes), labelled by checksums and
assignments. Texts are scanned whole and features see whole candidates (lengths above
``LONG`` count alike); a digit group begins a bounded number of sequences, so the
candidates are linear in the text.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "national", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}
SYNTHETIC = 6_000
SAMPLE_DOCS = 2_000
SAMPLE_CANDIDATES = 100  # of one sampled document
LONG = 200               # code points; longer candidates have this length as a feature
TREES, DEPTH, BINS, RATE = 60, 3, 32, 0.3
PRECISION = 0.98

# patterns of the base kinds; possessive repeats where no shorter match could succeed
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# where digits are: all base matches but emails lie inside such a run
_DIGITS = re.compile(r"[+0-9][+0-9().\x20-]*")
_LOOSE_PHONE = re.compile(r"\(?[0-9][0-9().\x20-]{5,30}[0-9]")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{16,}+")
_GROUP = re.compile(r"[0-9]+")
_MORE_BEFORE = re.compile(r"[0-9][().\x20-]{1,3}$")
_MORE_AFTER = re.compile(r"[().\x20-]{1,3}\+?[0-9]")
_HAS_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ASSIGNED = re.compile(r"(token|key|secret|password|passwd|pwd|api|auth|credential)\w*\W{0,5}$", re.I)
_SPEAKS = {
    "phone": re.compile(r"(call|phone|tel|mobile|cell|fax|dial|text)\W*(\w+\W+)?$", re.I),
    "national": re.compile(r"(ssn|social|national|insurance|tax)\W*(\w+\W+){0,2}$", re.I),
    "bank": re.compile(r"(iban|bank|account|card|visa|pay)\W*(\w+\W+){0,2}$", re.I),
    "technical": re.compile(r"(version|release|isbn|order|no|part|page|commit|sha\d*|md5|serial|item|build|on|in|from|since)\W*$", re.I),
    "net": re.compile(r"(ip|host|server|address|ping|from|mail|email|contact)\W*(\w+\W+)?$", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _mod97(text: str) -> bool:
    t = text.replace(" ", "")
    t = t[4:] + t[:4]
    return int("".join(str(int(c, 36)) for c in t)) % 97 == 1


def valid(kind: str, text: str) -> bool:
    """The check of a kind on the text of a match."""
    if kind == "ip":
        return all(_small(p) for p in text.split("."))
    if kind == "card":
        d = _NOT_DIGIT.sub("", text)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_NOT_DIGIT.sub("", text)) <= 15
    if kind == "iban":
        return 15 <= len(text.replace(" ", "")) <= 34 and _mod97(text)
    return True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > done and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether its check passes) of all base matches."""
    out = [("email", a, b, True) for a, b in emails(text)] if "@" in text else []
    for run in _DIGITS.finditer(text):
        a, b = run.span()
        if b - a < 2:
            continue
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            for m in pattern.finditer(text, a, b):
                out.append((kind, m.start(), m.end(), valid(kind, m.group())))
    return out


def sequences(text: str, begin: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Spans of consecutive digit groups of a run that could be a card, a phone number or an
    address. A sequence has at most 19 digits, so each group begins a bounded number."""
    groups = [m.span() for m in _GROUP.finditer(text, begin, end)]
    for i, (a, _) in enumerate(groups):
        digits, card, phone, dotted = 0, True, True, True
        for j in range(i, len(groups)):
            c, d = groups[j]
            size = d - c
            digits += size
            if digits > 19:
                break
            if j > i:
                gap = text[groups[j - 1][1]:c]
                card = card and gap in (" ", "-")
                phone = phone and len(gap) <= 2 and "+" not in gap and 2 <= size <= 5
                dotted = dotted and gap == "."
                if not (card or phone or dotted):
                    break
            phone = phone and j - i < 5
            if card and 12 <= digits and luhn(_NOT_DIGIT.sub("", text[a:d])):
                yield "card", a, d
            if phone and j > i and 7 <= digits <= 15:
                yield "phone", a - (a > 0 and text[a - 1] in "+("), d
            if dotted and j - i == 3 and valid("ip", text[a:d]):
                yield "ip", a, d


def added_candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans of the looser generators, each once."""
    return list(dict.fromkeys(_loose(text)))


def _loose(text: str) -> list[tuple[str, int, int]]:
    out = []
    for run in _DIGITS.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        a = a - 1 if a and text[a - 1] == "(" else a
        for m in _LOOSE_PHONE.finditer(text, a, b):
            if 7 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
        for m in _NATIONAL.finditer(text, a, b):
            out.append(("national", m.start(), m.end()))
        out += sequences(text, a, b)
    if _HAS_DIGIT.search(text):
        out += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text)]
        for m in _SECRET.finditer(text):
            if _HAS_DIGIT.search(text, m.start(), m.end()):
                out.append(("secret", m.start(), m.end()))
                value = m.start() + m.group().rstrip("=").rfind("=") + 1
                if m.start() < value <= m.end() - 16 and _HAS_DIGIT.search(text, value, m.end()):
                    out.append(("secret", value, m.end()))
    return out


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s, before, after = text[start:end], text[max(0, start - 40):start], text[end:end + 5]
    n = len(s)
    digits = sum(c.isdigit() for c in s)
    upper = sum("A" <= c <= "Z" for c in s)
    lower = sum("a" <= c <= "z" for c in s)
    hexa = sum(c in "0123456789abcdefABCDEF" for c in s)
    marks = n - digits - upper - lower
    freq = [s.count(c) / n for c in set(s)]
    entropy = -sum(p * math.log2(p) for p in freq if p > 0)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    numbers = _GROUP.findall(s)
    plain = "".join(numbers)
    values = [int(x) if len(x) < 10 else 10 ** 10 for x in numbers] or [0]
    return [*[float(kind == k) for k in KINDS], min(n, LONG), min(digits, LONG), upper / n, lower / n, hexa / n, min(marks, LONG),
            entropy, turns / n, len(numbers), max(map(len, numbers), default=0), min(map(len, numbers), default=0),
            float(bool(plain) and luhn(plain)), min(max(values), 1000),
            float(len(numbers) == 4 and all(v <= 255 for v in values)), s.count("."), s.count("-"),
            float(s[:1] in "+("), float(kind == "iban" and valid("iban", s)),
            float(bool(_ASSIGNED.search(before))), *[float(bool(p.search(before))) for p in _SPEAKS.values()],
            float(before[-1:].isalnum()), float(after[:1].isalnum()),
            float("=" in before[-4:] or ":" in before[-4:] or '"' in before[-2:]), s.rstrip("=").count("="),
            float(bool(_MORE_BEFORE.search(before))), float(bool(_MORE_AFTER.match(after))),
            s.count("(") - s.count(")"), float(bool(re.fullmatch(r"[0-9]{3}", numbers[0]) if numbers else None))]


@dataclass
class Trees:
    """Boosted trees of one depth: in each inner node a feature and the bin it splits at."""
    edges: list[np.ndarray]
    feature: np.ndarray  # [trees, 2 ** DEPTH - 1]
    split: np.ndarray
    leaf: np.ndarray     # [trees, 2 ** DEPTH]
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        rows, out = np.arange(len(b)), np.full(len(b), self.start)
        for feature, split, leaf in zip(self.feature, self.split, self.leaf):
            node = np.zeros(len(b), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > split[node])
            out += leaf[node - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order gradient boosting with logistic loss on binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    inner = 2 ** DEPTH - 1
    trees = Trees(edges, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64),
                  np.zeros((0, inner + 1)), math.log(rate / (1 - rate)))
    b = trees.binned(x)
    margin = np.full(len(y), trees.start)
    made = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, split = np.zeros(inner, np.int64), np.full(inner, BINS)
        for level in range(DEPTH):
            for k in range(2 ** level - 1, 2 ** (level + 1) - 1):
                at = np.flatnonzero(node == k)
                if len(at) < 20:
                    continue
                total_g, total_h = g[at].sum(), h[at].sum()
                best = 1e-6
                for j in range(x.shape[1]):
                    left_g = np.cumsum(np.bincount(b[at, j], g[at], BINS))
                    left_h = np.cumsum(np.bincount(b[at, j], h[at], BINS))
                    right_g, right_h = total_g - left_g, total_h - left_h
                    gain = left_g ** 2 / (left_h + 1) + right_g ** 2 / (right_h + 1) - total_g ** 2 / (total_h + 1)
                    c = int(np.argmax(gain))
                    if gain[c] > best:
                        best, feature[k], split[k] = gain[c], j, c
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > split[node])
        leaf = np.zeros(inner + 1)
        for k in range(inner + 1):
            at = node == k + inner
            leaf[k] = -RATE * g[at].sum() / (h[at].sum() + 1)
        margin += leaf[node - inner]
        made.append((feature, split, leaf))
    trees.feature, trees.split, trees.leaf = (np.stack(v) for v in zip(*made))
    return trees


@dataclass
class Model:
    trees: Trees
    slope: float
    offset: float
    threshold: dict[str, float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.trees.margin(x) + self.offset)))


def synthetic(n: int = SYNTHETIC, seed: int = 11) -> list[tuple[str, str, int, int, int]]:
    """(kind, text, start, end, label): candidates from seeded rules, with hard negatives.

    The generators run over each text: a candidate is positive where the rules put an item of
    its kind, and negative where it overlaps one otherwise or stands for a hard negative.
    """
    rng = np.random.RandomState(seed)
    pick = lambda *x: x[rng.randint(len(x))]
    number = lambda k: "".join(map(str, rng.randint(0, 10, k)))
    word = lambda: "".join(pick(*"abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9)))
    hexa = lambda k: "".join(pick(*"0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(pick(*"ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(k))

    def card(ok: bool) -> str:
        while True:
            d = pick("4", "5") + number(15)
            if luhn(d) == ok:
                sep = pick("", " ", "-")
                return sep.join(d[i:i + 4] for i in range(0, 16, 4))

    def iban(ok: bool) -> str:
        body, land = number(18), pick("DE", "FR", "ES", "GB")
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        return f"{land}{(check if ok else (check + 13) % 97):02d}{body}"

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}")

    out = []
    for _ in range(n):
        kind, label = KINDS[rng.randint(len(KINDS))], int(rng.randint(2))
        lead = " ".join(word() for _ in range(rng.randint(0, 4)))
        if kind == "email":
            s = f"{word()}.{number(2)}@{word()}.{pick('com', 'org', 'example.com')}" if label else f"{word()}@{word()}"
        elif kind == "ip":
            s = ".".join(str(rng.randint(1, 256)) for _ in range(4)) if label else ".".join(
                str(rng.randint(200, 999)) for _ in range(4))
        elif kind == "card":
            s = card(bool(label))
        elif kind == "iban":
            s = iban(bool(label))
        elif kind == "phone":
            if label:
                s = phone()
                lead += pick(" call", " phone", " tel", " mobile:", " fax") if rng.rand() < 0.9 else ""
            else:
                s = pick(f"20{number(2)}-0{rng.randint(1, 9)}-1{number(1)}", number(rng.randint(7, 12)), f"19{number(2)} - 20{number(2)}",
                         f"{number(1)} {number(3)} {number(3)}.{number(2)}", f"978-3-{number(2)}-{number(6)}-{number(1)}",
                         f"{number(2)}.{number(2)}.{number(4)}", phone())
                lead += pick("", " isbn", " order", " in", " no.", " version", " page")
        elif kind == "national":
            s = f"{number(3)}-{number(2)}-{number(4)}"
            lead += pick(" ssn", " social security number", " ssn:") if label else pick("", " part", " order", " item", " no.")
        else:
            if label:
                s = pick(hexa(40), hexa(32), hexa(64), mixed(rng.randint(20, 44)))
                lead += pick(' token = "', " api_key=", " secret: ", ' password = "', " auth token ", ' key="',
                             " SECRET_KEY=", f" {word().upper()}_TOKEN=", f" https://{word()}.example.com/{word()}?access_token=",
                             " export API_TOKEN=", f" {word()}_password=")
            else:
                s = pick(f"{word()}{word()}{word()}_{word()}{number(1)}", "-" * 14 + number(2), hexa(40), "a" * 10 + number(8),
                         f"{word()}/{word()}/{word()}{number(1)}", f"{word()}-{word()}-{word()}-{number(4)}", number(20), hexa(32))
                lead += pick("", " commit ", " sha256 ", " md5 ", " build ", " see ", " commit=", " sha256=", f" {word()}=")
        lead = lead + ("" if lead[-1:] in "\" =" else " ")
        made = [s]
        if label and kind in ("card", "phone", "ip") and rng.rand() < 0.4:  # a row of items
            again = {"card": lambda: card(True), "phone": phone, "ip": lambda: ".".join(str(rng.randint(1, 256)) for _ in range(4))}[kind]
            made += [again() for _ in range(rng.randint(1, 4))]
        text, items, between = lead, set(), pick(" ", " ", ", ", "  ")
        for k, x in enumerate(made):
            text += between if k else ""
            items.add((kind, len(text), len(text) + len(x)))
            text += x
        begin, end = len(lead), len(text)
        text += pick(" ", ". ", '" ', ", ") + word()
        for k, a, b in dict.fromkeys([c[:3] for c in base_spans(text)] + added_candidates(text)):
            if a < end and begin < b:
                out.append((k, text, a, b, int(label and (k, a, b) in items)))
    return out


def weak_label(kind: str, text: str, start: int, end: int) -> int | None:
    """Label of a corpus candidate where a checksum or an assignment gives one, else None."""
    s = text[start:end]
    if kind == "secret" and "=" in s.rstrip("="):  # the name of the key is not secret
        return 0 if _ASSIGNED.search(s[:s.rstrip("=").rfind("=") + 1]) else None
    if kind in ("ip", "card") and (_MORE_BEFORE.search(text[max(0, start - 4):start]) or _MORE_AFTER.match(text[end:end + 5])):
        return None  # inside a longer run: its check was the generator's, and holds by chance
    if kind in ("ip", "card", "iban"):
        return int(valid(kind, s))
    if kind == "email":
        return 1
    if kind == "secret":
        return 1 if _ASSIGNED.search(text[max(0, start - 40):start]) else None
    return None


def train(examples: list[tuple[list[float], int]], seed: int = 5) -> Model:
    x, y = np.array([e[0] for e in examples]), np.array([e[1] for e in examples], float)
    order = np.random.RandomState(seed).permutation(len(y))
    held, learn = order[:len(y) * 3 // 10], order[len(y) * 3 // 10:]
    model = Model(boost(x[learn], y[learn]), 1.0, 0.0, {})
    m, t = model.trees.margin(x[held]), y[held]
    for _ in range(25):  # Platt scaling by Newton steps
        p = 1 / (1 + np.exp(-(model.slope * m + model.offset)))
        w, r = np.maximum(p * (1 - p), 1e-6), p - t
        hess = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(r * m).sum(), r.sum()])
        model.slope, model.offset = model.slope - step[0], model.offset - step[1]
    p = model.probability(x[held])
    for k, kind in enumerate(KINDS):
        own = x[held, k] == 1
        best = np.argsort(-p[own])
        right = np.cumsum(t[own][best]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        model.threshold[kind] = max(0.5, float(p[own][best][good[-1]])) if len(good) else 2.0
    return model


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (x, label): labelled candidates of the sampled texts."""
    for batch in batches:
        xs, ys = [], []
        for text in batch.column(0).to_pylist():
            text = text or ""
            known = [(c, y) for c in dict.fromkeys([s[:3] for s in base_spans(text)] + added_candidates(text))
                     if (y := weak_label(c[0], text, *c[1:])) is not None]
            if len(known) > SAMPLE_CANDIDATES:
                known.sort(key=lambda z: zlib.crc32(f"{z[0]}".encode()))
            for (kind, a, b), label in known[:SAMPLE_CANDIDATES]:
                xs.append(features(kind, text, a, b))
                ys.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.int32())],
                                         names=["x", "label"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Train on the synthetic candidates and those of about ``sample_docs`` documents."""
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    rows = docs.select(F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(3)).alias("h"))
    drawn = F.pmod(F.col("h"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    # equal ids with equal texts would come all or none
    got = rows.where(drawn).dropDuplicates(["h"]).select("text").mapInArrow(
        _examples, "x array<double>, label int").toArrow()
    corpus = sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    return train([(features(k, t, a, b), y) for k, t, a, b, y in synthetic()] + corpus)


def find(texts: list[str], model: Model) -> list[list[tuple[str, int, int, bool, float]]]:
    """For each text, (kind, start, end, base, probability) of its spans by start, then kind."""
    base = [[s for s in base_spans(t) if s[3]] for t in texts]
    rows, x = [], []
    for i, t in enumerate(texts):
        own = sorted((a, b) for _, a, b, _ in base[i])
        reach = []  # ends of base spans, as a running maximum, for the overlap test
        for _, b in own:
            reach.append(max(b, reach[-1] if reach else 0))
        starts = [a for a, _ in own]
        for kind, a, b in added_candidates(t):
            k = int(np.searchsorted(starts, b)) if starts else 0
            if k and reach[k - 1] > a:
                continue
            rows.append((i, kind, a, b))
            x.append(features(kind, t, a, b))
    out = [[(k, a, b, True, 1.0) for k, a, b, _ in spans] for spans in base]
    if x:
        p = model.probability(np.array(x))
        taken: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(range(len(rows)), key=lambda r: (rows[r][0], -p[r], rows[r][2:], rows[r][1])):
            i, kind, a, b = rows[r]
            if p[r] >= model.threshold[kind] and all(b <= c or a >= d for c, d in taken.setdefault(i, [])):
                taken[i].append((a, b))
                out[i].append((kind, a, b, False, float(p[r])))
    return [sorted(s, key=lambda z: (z[1], ORDER[z[0]], z[2])) for s in out]


def _finder(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, text) -> (id, spans)."""
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                found = find([t or "" for t in part.column(1).to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([[{"kind": k, "start": a, "end": b, "base": c, "p": p} for k, a, b, c, p in s]
                                               for s in found], SPANS)], names=["id", "spans"])
    return run


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("base", pa.bool_()), ("p", pa.float64())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, spans), spans by start, then kind.

    A span has kind, start and end (code points, end exclusive), whether it is a base span,
    and its calibrated probability. A null text counts as empty and has no spans; repeated
    rows get the same spans; an empty table gives an empty table (the model is then trained
    on synthetic candidates alone). Other columns are not looked at.
    """
    model = model or fit(docs, id_col, text_col)
    t = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,p:double>>"
    out = t.mapInArrow(_finder(model), f"id {t.schema['id'].dataType.simpleString()}, spans {kind}")
    return out.withColumnRenamed("id", id_col)


def redact(text: str, spans: list[tuple[str, int, int, bool, float]]) -> str:
    """The text with each span replaced by its kind; overlapping spans count as one."""
    out, at = [], 0
    for kind, a, b, *_ in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def span_digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans and the list of all spans, from ``find_pii``."""
    def joined(only_base: bool):
        s = F.filter("spans", lambda x: x["base"]) if only_base else F.col("spans")
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return spans.select(id_col, *[count(k) for k in BASE_KINDS], F.sha2(joined(True), 256).alias("base_sha256"),
                        joined(False).alias("spans"))


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
