"""Secret scan (operator 1).

Two layers over every whole text:

* base patterns -- assignments, access-key ids and long hexadecimal runs;
* credential-context values -- whatever follows a credential word and ``:`` or
  ``=`` -- rated by a password guess-cost dynamic program: the value is cut
  into words, dates, repeats, keyboard walks and brute-force spans so that the
  total of log10 guesses is least. Values that would take at least
  ``min_log10_guesses`` are reported as spans of kind ``guess``, also where
  they lie inside a base span; base spans never go.

Defined cases: a null or empty text has no spans; overlapping kinds are all
reported; repeated rows each give a row; a null ``doc_id`` is kept as it is.
An empty table gives an empty result; a text of any length is scanned whole.
Extra columns are ignored. Work is one Arrow pass, no shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the scan's definition.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # 16 characters with its head
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"""(pass[_-]?(?:word|wd|phrase|code)|pwd|secret|token|credentials?|(?:api|access|private|auth)[_-]?key|bearer|login)"""
    r"""["']?[\x20\t]*[:=][\x20\t]*["'`]?([^\s"'`<>]+)""", re.IGNORECASE | re.ASCII)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "credential", "key", "bearer", "login")

# Common password words, most common first: a word's place is its guess count.
COMMON_WORDS = (
    "password pass admin welcome letmein login master dragon monkey shadow sunshine princess football "
    "baseball superman batman trustno hello freedom whatever secret access love money test guest root "
    "user default changeme summer winter spring autumn monday friday january december company server "
    "database system example sample dummy placeholder token value none null true false unknown hidden "
    "public private internal company john michael jordan charlie jessica daniel thomas robert ashley"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
DATE = re.compile(r"(?:\d{1,2}[-/._]?\d{1,2}[-/._]?(?:19|20)\d\d|(?:19|20)\d\d[-/._]?\d{1,2}[-/._]?\d{1,2}|(?:19|20)\d\d)")
LETTERS = re.compile(r"[A-Za-z]{3,}")
DATE_COST = math.log10(365 * 120)
YEAR_COST = math.log10(120)
UNLISTED_WORD = 6.0   # an unlisted word is one of a million
LONGEST_UNLISTED = 15
# Letter pairs that are common in English, German, French and Spanish words: two
# thirds of a word's pairs are among them, of random letters' pairs one third.
PAIRS = frozenset((
    "th he in er an re nd on en at ou ed ha to or it is hi es ng st ar te se me sa ve le al ro ri de ra co li ne io ic la "
    "el ti as ce ur ma ch si om ta us ec ho ca ut ss em ns ol et ac il nt un wa be di no pe ll so ul ei ie ck au ge sc mi "
    "am mo ad id ir po su tr pr pl ea ee oo oa ow ai ay ey ly ty ry sh wh gh ph fo fi fe fa ke ki ld rd rt rs ct ts if im "
    "op ap ep ab ag ig og ug ub av iv ov va vi vo da do du ga go gr ba bo bi br bl cl cr cu ci ex ev fr ja je jo ju ka ko "
    "lo lu mu na ni nu pa pi pu qu rc rm rn ru sp sw tu tt ue ui uc up we wi wo ye yo za ze zi zu ia ua ot os oc od of ok "
    "rg rk rl ks lt lf lk lm mp mb mm nc nk nn pp pt ff gi gn dr ds dl nv rv my by").split())
JOIN_COST = math.log10(2)
MAX_BLOCK = 8


def _next_key() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for row in ROWS:
        for a, b in zip(row, row[1:]):
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


NEAR = _next_key()


def _word_costs(words) -> dict[str, float]:
    return {w: math.log10(i + 2) for i, w in reversed(list(enumerate(words)))}


WORD_COST = _word_costs(COMMON_WORDS)
LONGEST_WORD = max(map(len, WORD_COST))


def plausible_word(run: str) -> bool:
    """Whether a run of letters looks like a word: of bounded length, all lower,
    all upper or capitalised, its letter pairs mostly common ones."""
    if len(run) > LONGEST_UNLISTED or not (run.isupper() or run[1:].islower()):
        return False
    low = run.lower()
    return 3 * sum(low[i:i + 2] in PAIRS for i in range(len(low) - 1)) >= 2 * (len(low) - 1)


def _segments(v: str, word_cost: dict[str, float], longest: int):
    """All non-brute-force spans of ``v``: (start, end, log10 guesses)."""
    low = v.lower()
    plain = "".join(LEET.get(c, c) for c in low)
    n = len(v)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            cost = word_cost.get(low[i:j])
            if cost is not None:
                yield i, j, cost + (JOIN_COST if v[i:j] != low[i:j] else 0.0)
            elif (cost := word_cost.get(plain[i:j])) is not None:
                yield i, j, cost + 2 * JOIN_COST
        if m := DATE.match(v, i):
            yield i, m.end(), YEAR_COST if m.end() - i == 4 else DATE_COST
    for m in LETTERS.finditer(v):
        if plausible_word(m.group()):  # other runs take brute force
            yield m.start(), m.end(), min(float(m.end() - m.start()), UNLISTED_WORD)
    i = 0
    while i < n - 2:  # keyboard walks and sequences: longest runs of neighbours
        j = i + 1
        turns = 0
        while j < n and low[j] in NEAR.get(low[j - 1], ()):
            if j >= i + 2 and low[j] == low[j - 2]:
                turns += 1
            j += 1
        if j - i >= 3:
            yield i, j, math.log10(47 * (j - i)) + turns * JOIN_COST
        i = max(j - 1, i + 1)


def _repeats(v: str):
    """Maximal runs of a repeated block: (start, block length, end)."""
    n = len(v)
    for b in range(1, min(MAX_BLOCK, n // 2) + 1):
        i = 0
        while i + 2 * b <= n:
            j = i
            while j + b < n and v[j] == v[j + b]:
                j += 1
            count = (j - i) // b + 1
            if count >= (3 if b == 1 else 2):
                yield i, b, i + count * b
                i = j + 1 if b > 1 else j + b
            else:
                i = j + 1


@lru_cache(maxsize=20_000)
def guess_cost(value: str, words: tuple[str, ...] | None = None) -> float:
    """log10 of the least number of guesses over all segmentations of ``value``.

    Brute force costs one digit of guesses a character; every cut costs
    log10(2). Work is linear in the length for bounded word and block lengths.
    """
    word_cost, longest = (WORD_COST, LONGEST_WORD) if words is None else (
        _word_costs(words), max(map(len, words), default=3))
    n = len(value)
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in _segments(value, word_cost, longest):
        ending.setdefault(j, []).append((i, cost))
    for i, b, j in _repeats(value):
        block = value[i:i + b]
        cost = float(b) if b < 3 else min([float(b)] + [c for s, e, c in _segments(block, word_cost, longest)
                                                        if (s, e) == (0, b)])
        ending.setdefault(j, []).append((i, cost + math.log10((j - i) // b)))
    # best[k]: least cost of value[:k]; brute[k]: the same with an open brute-force span at the end
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for k in range(1, n + 1):
        cut = JOIN_COST if k > 1 else 0.0
        brute[k] = min(brute[k - 1] + 1.0, best[k - 1] + 1.0 + cut)
        best[k] = min([brute[k]] + [best[i] + c + (JOIN_COST if i else 0.0) for i, c in ending.get(k, ())])
    return best[n]


def scan_text(text: str, min_log10_guesses: float = 7.0, words: tuple[str, ...] | None = None):
    """Spans (kind, start, end) of one text; offsets in code points."""
    if not text:
        return []
    low = text.lower()
    spans = []
    if any(w in low for w in ASSIGN_WORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                 if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if (":" in text or "=" in text) and any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            value = m.group(2).rstrip(".,;:)]}")
            start, end = m.start(2), m.start(2) + len(value)
            if value and guess_cost(value, words) >= min_log10_guesses:
                spans.append(("guess", start, end))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_log10_guesses: float = 7.0, words: tuple[str, ...] | None = None) -> DataFrame:
    """One row per document: id, list of spans (kind, start, end, log10 guesses
    of ``guess`` spans, else null)."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    id_type = src.schema["id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("log10_guesses", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("t"):
                text = text.as_py() or ""
                rows.append([{"kind": k, "start": s, "end": e,
                              "log10_guesses": guess_cost(text[s:e], words) if k == "guess" else None}
                             for k, s, e in scan_text(text, min_log10_guesses, words)])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, kind)], names=["id", "spans"])

    out = src.mapInArrow(scan, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,log10_guesses:double>>")
    return out.withColumnRenamed("id", id_col)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the base spans' digest and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    base = F.filter("spans", lambda s: s.kind != "guess")
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long")
    return scanned.select(
        F.col(id_col).alias("doc_id"),
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        count("guess").alias("n_guess"))
