import hashlib
import math
import random
import re
import string

from loomgraph.llm import secrets

DOCS = "doc_id bigint, text string"
ASSIGN = re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def brute(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def made(seed, n):
    rng = random.Random(seed)
    pool = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "AKIAAKIA", "ABCD1234", "0123456789abcdef", "deadbeef", "é", "漢", "\n", "x", "😀", "Z9", "+/", "-_", "tok", "secretly"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def check(spark, rows):
    got = secrets.secret_digests(spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", base string")).collect()
    want = []
    for doc, text in rows:
        base = brute(text)
        want.append((doc, *(sum(s[0] == k for s in base) for k in secrets.KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(), base))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((w[:5] for w in want), key=str)
    return got, want


def test_base_spans(spark):
    rows = [(k, t) for k, t in enumerate(made(1, 500))]
    rows += [(-1, None), (-2, ""), (-2, ""), (None, "token: abcdef1"), (-3, "secret=token: abcdefgh"), (-4, "token = 'ab' " * 3000), (-5, "a1" * 50_000)]
    got, want = check(spark, rows)
    base = {w[0]: w[5] for w in want if w[0] is not None}
    for r in got:
        if r.doc_id is not None:
            spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
            assert [s for s in spans if s[0] != "random"] == base[r.doc_id]
            assert spans == sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_random_tokens_are_added(spark):
    """Random tokens among words: most are found; long words and patterned tokens are left alone."""
    rng = random.Random(4)
    words = ["internationalisierungsmassnahme", "gesellschaftswissenschaftlich", "incomprehensibilities", "counterrevolutionaries", "benutzerfreundlichkeiten"]
    token = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    rows, hidden = [], {}
    for k in range(300):
        hidden[k] = token() if k % 3 == 0 else ("abc123" * 7 if k % 3 == 1 else None)
        rows.append((k, " ".join(rng.choice(words) for _ in range(12)) + (f" {hidden[k]} " if hidden[k] else "") + "end"))
    got = {r.doc_id: r.spans for r in secrets.secret_digests(spark.createDataFrame(rows, DOCS)).collect()}
    found = [k for k, s in got.items() if "random" in s]
    # The only null words here are shorter than the tokens, which makes the rule cautious.
    assert sum(k % 3 == 0 for k in found) >= 70
    assert sum(k % 3 != 0 for k in found) <= 5


ALPHABETS = [string.digits, string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_lowercase, string.ascii_uppercase, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.ascii_uppercase + string.ascii_lowercase, string.ascii_uppercase + string.ascii_lowercase + string.digits, string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"]


def plain_score(token):
    """-ln of the p-value by Fisher's method of three tests in the least alphabet, with exact normal tails."""
    signs = next((a for a in ALPHABETS if set(token) <= set(a)), string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_+/")
    n, k, x = len(token), len(signs), [signs.index(c) for c in token]
    tail = lambda z: max(1e-30, math.erfc(z / math.sqrt(2)) / 2)
    squares = sum(x.count(v) ** 2 for v in set(x))
    chi = (k * squares / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n))
    upper = [v >= k / 2 for v in x]
    expected = 2 * sum(upper) * (n - sum(upper)) / n + 1
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:], strict=False))
    rz = 10 if expected <= 2 else abs(runs - expected) / math.sqrt((expected - 1) * (expected - 2) / (n - 1))
    mean = sum(x) / n
    spread = sum((v - mean) ** 2 for v in x)
    sz = 10 if not spread else abs(n * sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / spread + 1) / math.sqrt(n)
    f = -(math.log(tail(chi)) + math.log(min(1, 2 * tail(rz))) + math.log(min(1, 2 * tail(sz))))
    return f - math.log(1 + f + f * f / 2)


def test_added_spans_against_plain_code(spark):
    """The battery, the rule of Benjamini and Hochberg in each length class and the overlaps, again in Python."""
    rng = random.Random(21)
    token = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    made_ = [token(rng.choice([20, 24, 30, 44, 70])) for _ in range(150)] + ["aaaa1111" * 4, "abcabc123" * 5, "x1" * 30, "v2-of-the-file-with-notes", "path/to/the/page/number/2024/index", "ABCDEFGHIJKLMNOPQRSTU1"] * 3
    rng.shuffle(made_)
    texts = [f"{a} and {b}, token={c}" for a, b, c in zip(made_[::3], made_[1::3], made_[2::3], strict=False)] + ["", None]
    got = {r.doc_id: r.spans for r in secrets.secret_digests(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    tokens = {m[0] for t in texts for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t or "") if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])}
    of = lambda t: max(k for k, least in enumerate(secrets.CLASSES) if len(t) >= least)
    admitted, near = set(), set()
    for k in range(len(secrets.CLASSES)):
        own = sorted((min(200, math.floor(plain_score(t) * 4)), t) for t in tokens if of(t) == k)
        cut = min((b for b in range(201) if any(c >= b for c, _ in own) and math.exp(-b / 4) * len(own) / sum(c >= b for c, _ in own) <= 0.05), default=201)
        admitted |= {t for c, t in own if c < cut}
        near |= {t for c, t in own if abs(c - cut) <= 1}  # the tails of the query are approximate
    sure = 0
    for k, text in enumerate(texts):
        base = brute(text)
        want = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text or "") if m[0] in admitted and not any(s < m.end() and m.start() < e for _, s, e in base)]
        found = [tuple(map(int, x.split(":")[1:])) for x in got[k].split(",") if x.startswith("random")]
        if not any(m[0] in near for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text or "")):
            assert found == [w[:2] for w in want], text
            sure += len(found)
    assert sure > 60


def test_no_python_in_the_plan(spark):
    df = secrets.secret_digests(spark.createDataFrame([(1, "x")], DOCS))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_empty_table(spark):
    assert secrets.secret_digests(spark.createDataFrame([], DOCS)).count() == 0


def test_random_tokens_of_any_corpus(spark):
    """Few tokens and no long words, and the same with a hot group of copies: the same spans."""
    rng = random.Random(8)
    token = lambda n, signs: "".join(rng.choice(signs) for _ in range(n))
    few = [(k, f"see {token(40, string.ascii_letters + string.digits)} here") for k in range(40)]
    few += [(40 + k, f"see /docs/release-notes-of-the-year-20{k}/index-of-all-pages end") for k in range(10)]
    hot = [(100, f"{token(32, string.ascii_letters)} and /blog/news-and-notes-of-the-team-2024/all-entries-in-order")] * 3000
    spans = lambda rows: {r.doc_id: r.spans for r in secrets.secret_digests(spark.createDataFrame(rows, DOCS)).collect()}
    alone, crowd = spans(few), spans(few + hot)
    assert sum("random" in alone[k] for k in range(40)) >= 34
    assert not any("random" in alone[k] for k in range(40, 50))
    print("random of 40:", sum("random" in alone[k] for k in range(40)))
    assert {k: crowd[k] for k in alone} == alone and "random" not in crowd[100]
    assert sum("random" in x for x in spans(few[:5]).values()) >= 3
