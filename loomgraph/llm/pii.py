"""Personal data by gradient boosting over candidate spans.

Base spans (email, ip, card, phone) are matches of fixed patterns and always stay. Further
kinds come from high-recall generators that propose overlapping candidates: addresses
written around (`name at host dot org`, `name(at)host.org`, `name @ host.org`), account numbers (IBAN),
identity numbers (3-2-4 digits) and local phone numbers. Boosted trees score each candidate by its
format (lengths, digits, separators, check sums) and context (words before it, characters beside
it). Their scores are calibrated, and a threshold is chosen for each kind, on candidates of another
source than the trees have learned from: the least threshold that keeps the precision there at
`precision` or more. No kind can be switched off: if no threshold of a kind reaches that precision,
training raises an error. Of overlapping candidates the best stays (ties: by start, kind, end); none may
overlap a base span.

No table labels personal data, so the trees learn from sentences of made-up words (`_sentences`,
`_crowded`; fixed seed and number), and thresholds come from sentences in four languages with other
formats and with numbers and phrases that only look like such data (`_calibration`). Positions are code
points. Null texts count as empty; texts are searched whole, each pattern in time linear in the text.
Repeated rows are searched each; empty tables give empty tables; pii_digests() reads no other
columns than the id and the text, redact_pii() keeps all others, whatever their names.
"""

from __future__ import annotations

import bisect
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import doc_columns, sigmoid
from loomgraph.session import prepare

BASE = ("email", "ip", "card", "phone")
ADDED = ("hidden_email", "iban", "identity", "local_phone")
#: Kinds in the order of ties.
KINDS = BASE + ADDED

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _HOST.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping in each kind, by start and kind."""
    out = _emails(text)
    if _DIGIT.search(text):
        for run in _DOTTED.finditer(text):
            if run[0].count(".") >= 3:
                out += [(run.start() + m.start(), run.start() + m.end(), "ip") for m in _IP.finditer(run[0]) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


_AT = re.compile(r"(?i:\bat\b|\(at\)|\[at\]|\{at\})| @|@ ")
_BEFORE_AT = re.compile(r"(?<![\w.])[\w.+-]{1,64} ?\Z")
_DOT_LABEL = r" ?(?i:\(dot\)|\[dot\]|\bdot\b|\.) ?[A-Za-z0-9-]{2,63}"
#: Hosts of two to five labels: each length is a proposal.
_HOSTS = tuple(re.compile(rf" ?[A-Za-z0-9-]{{1,63}}(?:{_DOT_LABEL}){{{n}}}") for n in range(1, 5))
_MORE_HOST = re.compile(_DOT_LABEL)
_IBAN_HEAD = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
# The longest match of each kind at a start, then what else may end there.
_GENERATORS = (
    ("iban", re.compile(_IBAN_HEAD + r"(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), tuple(re.compile(rf"{_IBAN_HEAD}(?: ?[A-Z0-9]{{4}}){{{n}}}{tail}(?![A-Za-z0-9])") for n in range(2, 8) for tail in ("", " ?[A-Z0-9]{1,3}"))),
    ("identity", re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])"), ()),
    ("local_phone", re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])"), ()),
)

# Words that stand before such data.
CONTEXT = {
    "hidden_email": "mail email e-mail write contact reach address correo courriel adresse".split(),
    "iban": "iban account bank konto cuenta compte transfer".split(),
    "identity": "ssn social identity security id number nummer".split(),
    "local_phone": "phone call tel telephone mobile fax telefon teléfono telefono téléphone ring".split(),
}


def candidates(text: str) -> list[Span]:
    """All proposals of all generators, at every mark and start; they may overlap."""
    out: list[Span] = []
    for mark in _AT.finditer(text):
        # Only around its mark, so that long runs of letters cost nothing.
        m = _BEFORE_AT.search(text, max(0, mark.start() - 65), mark.start())
        for pattern in _HOSTS if m else ():
            host = pattern.match(text, mark.end())
            if not host:
                break
            out.append((m.start(), host.end(), "hidden_email"))
    if _DIGIT.search(text):
        for kind, pattern, others in _GENERATORS:
            m = pattern.search(text)
            while m:
                ends = {m.end(), *(x.end() for p in others if (x := p.match(text, m.start())))}
                out += [(m.start(), end, kind) for end in sorted(ends)]
                m = pattern.search(text, m.start() + 1)
    return out


def _mod97(value: str) -> bool:
    s = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


_DIGITS_BEFORE, _DIGITS_AFTER = re.compile(r"[0-9][ ./-]?$"), re.compile(r"[ ./-]?[0-9]")
_SAID_DOT = re.compile(r"\(dot\)|\[dot\]|\bdot\b")


def _more_host(text: str, span: Span) -> bool:
    """Whether a written-out dot and a label follow."""
    m = _MORE_HOST.match(text, span[1])
    return bool(m) and (m[0][:1] != "." or m[0][1:2] != " ")


def features(text: str, span: Span) -> list[float]:
    start, end, kind = span
    value, before = text[start:end], text[max(0, start - 32) : start].lower()
    groups = [g for g in re.split(r"[^A-Za-z0-9]+", value) if g]
    marks = re.findall(r"[^A-Za-z0-9]", value)
    digits = "".join(_DIGIT.findall(value))
    told = value.lower()
    named = set(re.findall(r"[\w-]+", before))
    return [
        *(float(kind == k) for k in ADDED),
        float(len(value)), float(len(digits)), float(len(groups)), float(len(set(marks))),
        float(len(groups[0])), float(len(groups[-1])),
        float(kind == "iban" and _mod97(value)), float(luhn(digits or "1")),
        float(any(w in named for w in CONTEXT[kind])),
        float(before[-1:].isalnum()), float(text[end : end + 1].isalnum()),
        float(any(x in told for x in ("(at)", "[at]", "{at}", "@"))), float(bool(_SAID_DOT.search(told))),
        *(float(sign in value) for sign in "- ./("),
        float(min(map(len, groups))), float(max(map(len, groups))),
        float(before[-1:] == "("), float(value.count("(") != value.count(")")),
        float(bool(_DIGITS_BEFORE.search(before))), float(bool(_DIGITS_AFTER.match(text, end))),
        float(kind == "hidden_email" and ". " in value), float(kind == "hidden_email" and _more_host(text, span)),
    ]


class Boosting:
    """Gradient boosted trees of depth 3 on the logistic loss, with binned features."""

    def __init__(self, rounds: int = 40, rate: float = 0.2, depth: int = 3, least: int = 8):
        self.rounds, self.rate, self.depth, self.least = rounds, rate, depth, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosting:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 17)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], 1)
        self.start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        score, self.trees = np.full(len(y), self.start), []
        for _ in range(self.rounds):
            p = sigmoid(score)
            tree = self._grow(bins, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            score += self._walk(tree, bins)
        return self

    def _grow(self, bins, g, h, rows, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        leaf = self.rate * total_g / (total_h + 1)
        if not depth or len(rows) < 2 * self.least:
            return leaf
        best = (1e-6, None)
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            at = bins[rows, f]
            gs, hs, ns = (np.bincount(at, w, len(cuts) + 1).cumsum()[:-1] for w in (g[rows], h[rows], None))
            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
            gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k))
        if best[1] is None:
            return leaf
        f, k = best[1]
        left = bins[rows, f] <= k
        return f, k, self._grow(bins, g, h, rows[left], depth - 1), self._grow(bins, g, h, rows[~left], depth - 1)

    def _walk(self, tree, bins) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(bins), tree)
        f, k, left, right = tree
        return np.where(bins[:, f] <= k, self._walk(left, bins), self._walk(right, bins))

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T, strict=True)], 1)
        return self.start + sum(self._walk(t, bins) for t in self.trees)


class CandidateModel:
    """Boosted trees, their calibration (a, b of a logistic curve) and the threshold of each kind."""

    def __init__(self, boosting: Boosting, a: float, b: float, thresholds: dict[str, float]):
        self.boosting, self.a, self.b, self.thresholds = boosting, a, b, thresholds

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * self.boosting.raw(x) + self.b)

    def spans(self, text: str, base: list[Span]) -> list[tuple[int, int, str, float]]:
        """Admitted candidates with their probabilities."""
        found = candidates(text)
        if not found:
            return []
        p = self.probability(np.array([features(text, s) for s in found]))
        starts, ends = [], []
        for s, e, _ in sorted(base):
            if ends and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        out = []
        for k in sorted(range(len(found)), key=lambda k: (-p[k], *_order(found[k]))):
            start, end, kind = found[k]
            at = bisect.bisect_left(starts, end) - 1
            if p[k] >= self.thresholds[kind] and (at < 0 or ends[at] <= start):
                bisect.insort(starts, start)
                ends.insert(starts.index(start), end)
                out.append((start, end, kind, float(p[k])))
        return out


def _sentences(n: int, seed: int) -> list[tuple[str, Span, bool]]:
    """Generated texts: the text, a candidate in it, and if that is personal data."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "th", "ion", "re", "st", "el", "os"]) for _ in range(rng.randint(1, 4)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def iban(valid: bool) -> str:
        country, account = rng.choice(["DE", "FR", "ES", "GB"]), digits(rng.choice([16, 18, 20]))
        check = 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97
        check = check if valid else (check + rng.randint(1, 90)) % 97 + 2
        s = f"{country}{check:02d}{account}"
        return s if rng.random() < 0.5 else " ".join(s[i : i + 4] for i in range(0, len(s), 4))

    out = []
    for _ in range(n):
        kind, good, sep = rng.choice(ADDED), rng.random() < 0.5, rng.choice(["-", " ", ".", "/"])
        if kind == "hidden_email":
            at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] ")])
            value = f"{word()}.{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'example'])}" if good else f"{word()} at {word()}. {word()}"
        elif kind == "iban":
            value = iban(good)
        elif kind == "identity":
            value = f"{digits(3)}-{digits(2)}-{digits(4)}" if good else f"{digits(3)} {digits(2)} {digits(4)}"
        else:
            value = f"({digits(3)}) {digits(3)}-{digits(4)}" if good and rng.random() < 0.5 else f"{digits(rng.choice([2, 3, 4]))}{sep}{digits(rng.choice([3, 4]))}{sep}{digits(rng.choice([3, 4]))}"
        named = rng.random() < (0.7 if good else 0.05)
        if kind in ("identity", "local_phone") and good and not named and not value.startswith("("):
            good = rng.random() < 0.3  # digits alone say little
        before = " ".join(word() for _ in range(rng.randint(1, 6))) + (f" {rng.choice(CONTEXT[kind])}{rng.choice([':', '', ' is'])}" if named else "")
        out.append((f"{before} {value} {word()} {word()}", (len(before) + 1, len(before) + 1 + len(value), kind), good))
    return out


def _crowded(n: int, seed: int) -> list[tuple[str, Span]]:
    """Generated texts with a plain `at` before or a sentence after a written-out address: the text and the address."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "th", "ion", "re", "st", "el", "os"]) for _ in range(rng.randint(1, 4)))
    out = []
    for _ in range(n):
        at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] ")])
        local = word() + (f".{word()}" if rng.random() < 0.5 else "")
        value = local + at + dot.join([*(word() for _ in range(rng.randint(1, 3))), rng.choice(["com", "org", "net", "example"])])
        value = value.upper() if rng.random() < 0.2 else value
        before = rng.choice([f"{word()} {word()} at {word()}. ", f"{word()} {word()} ", f"{word()} {rng.choice(CONTEXT['hidden_email'])}: "])
        after = rng.choice([f" {word()} {word()}", f". {word().capitalize()} {word()}", "", "."])
        out.append((before + value + after, (len(before), len(before) + len(value), "hidden_email")))
    return out


# Sentences for calibration; {} is where a value of the kind stands.
TOLD = {
    "hidden_email": ["Please write to {} if you have any questions.", "Contact: {}", "You can reach me under {} after six.", "Bitte schreiben Sie an {}.", "Mi correo es {}, gracias.", "Mon adresse: {} merci", "The editor ({}) decides.", "Questions? {}", "We left at noon. {} knows more."],
    "iban": ["IBAN {}", "Please transfer it to {} by Friday.", "Konto: {}", "Pay the rent ({}) on time.", "Mi cuenta es {}.", "Le compte {} est ouvert."],
    "identity": ["SSN {}", "Her social security number: {}", "My ssn is {}.", "Identity number {} was stolen.", "Seguridad social, number {}", "Id {}, born in May"],
    "local_phone": ["Call {} before noon.", "Phone: {}", "Tel. {}", "Mobile {} or fax", "Mein Telefon ist {}.", "El telefono es {}.", "Fax {}"],
}
# Sentences without personal data; {n} is a number of n digits.
UNTOLD = [
    "We met at noon. Then we left.", "She works at Siemens. Monday is fine.", "Look at home. The keys are there.", "They arrive at {2}.{2} or later.", "It sold at {1}.{2} each.", "He stayed at the inn. com is not a word.",
    "Schools at Vienna. Graz comes next.", "Look at www.host.org for more.", "Meet me at station dot, the big one.", "The crowd at large. And then some.", "Un sandwich at midi. Ensuite rien.", "We look @ numbers. Always.",
    "The area is {2} {3} {3} hectares.", "In {4} {4} {4} they met.", "A ratio of {2}/{3}/{4} is high.", "Version {2}.{3}.{4} is out.", "ISBN {3} {4} {4} in print.", "It costs {2}.{3}.{3} in all.", "Between {4} {3} {3} and more.", "Rows {3} {3} {4} are blank.",
    "Scores were {3} {2} {4} in the end.", "Sizes {3} {2} {4} fit.", "Seats {3} {2} {4} are taken.", "Of {3} {2} {4} votes none counted.",
    "Model AB{2} {4} {4} {4} arrived.", "Code XK{2}{4}{4}{4} failed.", "Batch DE{2} {4} {4} {4} {4} {2} was late.", "Part FR{2}{4}{4}{4}{4}{4} is sold out.",
]


def _iban(rng: random.Random, country: str, n: int) -> str:
    account = "".join(rng.choice("0123456789") for _ in range(n))
    check = 98 - int("".join(str(int(c, 36)) for c in account + country + "00")) % 97
    return f"{country}{check:02d}{account}"


def _calibration(n: int, seed: int) -> list[tuple[str, Span | None]]:
    """n texts: the text and its personal data, if it has some."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    names = ["anna.kovacs", "j_smith", "tom", "info", "maria-luisa", "k.o.brien", "sales2", "LOPEZ"]
    hosts = [["uni-graz", "at"], ["mail", "example", "org"], ["acme", "co", "uk"], ["posteo", "de"], ["lab7", "edu"], ["correo", "es"]]

    def value(kind: str) -> str:
        if kind == "hidden_email":
            at, dot = rng.choice([(" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "."), (" AT ", " DOT "), (" (at) ", " (dot) "), (" @ ", ".")])
            return rng.choice(names) + at + dot.join(rng.choice(hosts))
        if kind == "iban":
            s = _iban(rng, rng.choice(["AT", "NL", "ES", "DE", "IT"]), rng.choice([14, 16, 18, 20]))
            return s if rng.random() < 0.5 else " ".join(s[i : i + 4] for i in range(0, len(s), 4))
        if kind == "identity":
            return f"{digits(3)}-{digits(2)}-{digits(4)}"
        return rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"0{digits(3)} {digits(3)} {digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"0{digits(2)}/{digits(3)}/{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}"])

    out = []
    for k in range(n):
        if k % 2:
            out.append((re.sub(r"\{(\d)\}", lambda m: digits(int(m[1])), rng.choice(UNTOLD)), None))
        else:
            kind = ADDED[k // 2 % len(ADDED)]
            before, after = rng.choice(TOLD[kind]).split("{}")
            made = value(kind)
            out.append((before + made + after, (len(before), len(before) + len(made), kind)))
    return out


@lru_cache(maxsize=4)
def train_candidate_model(n: int = 6000, precision: float = 0.97, seed: int = 3) -> CandidateModel:
    x, y = [], []
    for text, told, good in _sentences(n, seed):
        for span in candidates(text):
            x.append(features(text, span))
            y.append(good and span == told)
    for text, address in _crowded(n // 3, seed + 1):
        for span in candidates(text):
            x.append(features(text, span))
            y.append(span == address)
    boosting = Boosting().fit(np.array(x), np.array(y, float))
    held = [(span, span == told, features(text, span)) for text, told in _calibration(n // 2, seed + 2) for span in candidates(text)]
    raw, target = boosting.raw(np.array([f for *_, f in held])), np.array([t for _, t, _ in held], float)
    kinds = np.array([span[2] for span, *_ in held])
    a, b = 1.0, 0.0
    for _ in range(300):
        p = sigmoid(a * raw + b)
        a -= 0.05 * float(((p - target) * raw).mean())
        b -= 0.05 * float((p - target).mean())
    p, thresholds = sigmoid(a * raw + b), {}
    for kind in ADDED:
        own = kinds == kind
        reached = [float(t) for t in np.unique(p[own]) if target[own][p[own] >= t].mean() >= precision]
        if not reached:
            raise ValueError(f"no threshold gives the kind {kind} a precision of {precision}")
        thresholds[kind] = reached[0]
    return CandidateModel(boosting, a, b, thresholds)


def find_in_text(text: str, model: CandidateModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, by start and kind."""
    base = base_spans(text)
    return base, sorted(base + [s[:3] for s in model.spans(text, base)], key=_order)


_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("kind", pa.string())]))
_SPANS_SQL = "array<struct<s: bigint, e: bigint, kind: string>>"


def find_pii(docs: DataFrame, model: CandidateModel | None = None) -> DataFrame:
    """doc_id, base, spans: arrays of (s, e, kind) by start and kind."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or train_candidate_model())  # 40 trees

    def run(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [find_in_text(t or "", known) for t in part.column(1).to_pylist()]
                packed = [pa.array([[{"s": s, "e": e, "kind": k} for s, e, k in f[i]] for f in found], _SPANS) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *packed], ["doc_id", "base", "spans"])

    return doc_columns(docs).mapInArrow(run, f"doc_id bigint, base {_SPANS_SQL}, spans {_SPANS_SQL}")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at, end = [], 0, -1
    for s, e, kind in spans:
        if s >= end:
            out += [text[at:s], f"[{kind.upper()}]"]
        end = at = max(end, e)
    return "".join([*out, text[at:]]) if spans else text


def redact_pii(docs: DataFrame, model: CandidateModel | None = None, length_col: str = "n_chars") -> DataFrame:
    """The rows and columns of docs with their texts redacted and length_col, if there, renewed. Null texts stay null."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or train_candidate_model())
    head, text_at = docs.columns, docs.columns.index("text")
    length_at = head.index(length_col) if length_col in head else -1

    def run(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t and redacted(t, find_in_text(t, known)[1]) for t in part.column(text_at).to_pylist()]
                columns = list(part.columns)
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if length_at >= 0:
                    columns[length_at] = pa.array([n if t is None else len(t) for t, n in zip(texts, columns[length_at].to_pylist(), strict=True)], columns[length_at].type)
                yield pa.RecordBatch.from_arrays(columns, head)

    return docs.mapInArrow(run, docs.schema)


def _text(spans: str) -> Column:
    return F.array_join(F.expr(f"transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e))"), ",")


def pii_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in BASE]
    return find_pii(docs).select("doc_id", *counts, F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))
