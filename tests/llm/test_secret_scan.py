import hashlib
import itertools
import math
import random
import re

from consentflow.llm import secret_scan as S
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs

ALPHABET = ["password", "Token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "ABCDEFGH1234", "a1b2c3d4" * 4, "deadbeef",
            "xK9#mQ2$vL", "\n", "é", "secret", "short", "2024", "qwerty", "K", "ſecret"]


def base_by_hand(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def all_segmentations(value):
    """Least cost over every way to cut ``value``, by trying them all."""
    segs = {}
    for i, j, c in S._segments(value, S.WORD_COST, S.LONGEST_WORD):
        segs[i, j] = min(c, segs.get((i, j), math.inf))
    for i, b, j in S._repeats(value):
        block = value[i:i + b]
        inner = [float(b)] + ([c for s, e, c in S._segments(block, S.WORD_COST, S.LONGEST_WORD) if (s, e) == (0, b)] if b >= 3 else [])
        segs[i, j] = min(min(inner) + math.log10((j - i) // b), segs.get((i, j), math.inf))
    n, best = len(value), math.inf
    for cuts in itertools.product([0, 1], repeat=n - 1):
        at = [0] + [i + 1 for i, c in enumerate(cuts) if c] + [n]
        cost = S.JOIN_COST * (len(at) - 2) + sum(min(float(j - i), segs.get((i, j), math.inf)) for i, j in zip(at, at[1:]))
        best = min(best, cost)
    return best


def test_guess_cost_is_the_least_over_all_segmentations():
    rng = random.Random(1)
    values = ["password1", "aaaa", "abcabc", "p@ss99", "qwe1999", "zz2001zz"] + [
        "".join(rng.choice("aab1290pas@w") for _ in range(rng.randint(1, 11))) for _ in range(60)]
    for v in values:
        assert math.isclose(S.guess_cost(v), all_segmentations(v)), v


def test_guess_cost_orders_values():
    assert S.guess_cost("password") < S.guess_cost("Summer2024!") < S.guess_cost("xK9#mQ2$vL")
    assert S.guess_cost("aaaaaaaaaaaaaaaa") < 3 and S.guess_cost("qwertyuiop") < 3
    assert S.guess_cost("") == 0.0
    assert S.guess_cost("blorptastic", words=("blorptastic",)) < S.guess_cost("blorptastic")


def test_base_spans_agree_with_plain_patterns_and_stay():
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 9)))
        got = S.scan_text(text)
        assert [s for s in got if s[0] != "guess"] == base_by_hand(text), text


def test_weak_values_are_no_guess_spans():
    assert all(k != "guess" for k, *_ in S.scan_text("password: password1"))
    assert ("guess", 6, 16) in S.scan_text("pwd = xK9#mQ2$vL")
    assert S.scan_text("the secret of the token is out, and the login too") == []


def test_rows_and_edges(spark):
    prepare(spark)
    df = edge_docs(spark, [(9, "Token: 'abcdefgh1' AKIA" + "B" * 12)])
    rows = S.digest(S.scan_secrets(df)).collect()
    assert len(rows) == df.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in rows if r.doc_id in (1, 2, 3))
    r = next(r for r in rows if r.doc_id == 9)
    assert (r.n_assign, r.n_access, r.n_hex) == (1, 1, 0)
    base = [s for s in r.spans.split(",") if not s.startswith("guess")]
    assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert S.digest(S.scan_secrets(null_docs(spark))).count() == 2
    assert S.digest(S.scan_secrets(empty_docs(spark))).count() == 0
    assert S.scan_secrets(docs_of(spark, [(1, "secret=" + "Zq7" * 40_000)])).first().spans[0].kind == "assign"


def test_values_of_letters_alone_are_guess_spans():
    rng = random.Random(3)
    assert ("guess", 4, 28) in S.scan_text("pwd=XqZvBnMkLpRtWsYdGhJcFaQe")
    assert ("guess", 12, 28) in S.scan_text("private_key=qnvhqzkdwxbtrgmc")
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmABCDEFGHIJKLM"):
        for n in (16, 24, 64):
            value = "".join(rng.choice(letters) for _ in range(n))
            assert ("guess", 11, 11 + n) in S.scan_text(f"passphrase={value}"), value
    found = sum(any(k == "guess" for k, *_ in S.scan_text("passcode=" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12))))
                for _ in range(500))
    assert found >= 470
    for word in ("administrator", "authentication", "Zeichen", "CONFIGURATION", "necesario", "required", "blorptastic"):
        assert S.scan_text(f"login: {word}") == [], word


def test_aligned_files_keep_their_spans():
    for gap in ("      ", "\t", " \t\t ", " " * 40):
        text = f"pwd{gap}={gap}xK9#mQ2$vL"
        assert ("guess", len(text) - 10, len(text)) in S.scan_text(text), text
    assert S.scan_text("pwd =\nxK9#mQ2$vL") == []
