"""Secret scans: fixed patterns against a direct reading, the battery, false discoveries."""

from __future__ import annotations

import hashlib
import random
import re
import string

import pytest
from llm_cases import SCHEMA, frame, odd_texts, words

from cohortkit.llm.secret_scan import ENCODINGS, MASK, battery, infer_encoding, masked, redact_secrets, scan_secrets

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def random_key(r: random.Random, n: int, alphabet: str = string.ascii_letters + string.digits) -> str:
    return "".join(r.choice(alphabet) for _ in range(n))


def corpus():
    r, out = random.Random(6), odd_texts()
    for i in range(150):
        body = words(60, 100 + i).split()
        kind = i % 10
        if kind == 0:
            body.insert(9, f'Password = "{random_key(r, 3 + i % 9)}"')
        elif kind == 1:
            body.insert(20, "AKIA" + random_key(r, 13 + i % 6, string.ascii_uppercase + string.digits))
        elif kind == 2:
            body.insert(5, random_key(r, 20 + i % 30, "0123456789abcdef"))
        elif kind == 3:
            body.insert(30, random_key(r, 44))
        elif kind == 4:
            body.insert(30, "internationalisationalisedcounterrevolutionaries")
        elif kind == 5:
            body.insert(3, "api_key:token=secret: x=Ab.c_9/d-f API-KEY=1 apikey='kkkkkkk' ſecret=abcdefgh toKen=abcdefgh")
        out.append((500 + i, "é " + " ".join(body)))
    return out


def direct(text: str):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def said(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_and_added_ones(spark):
    texts = corpus()
    got = sorted(scan_secrets(frame(spark, texts)).collect(), key=lambda r: (str(r["doc_id"]), r["spans"]))
    expected = sorted(((i, direct(t or "")) for i, t in texts), key=lambda x: (str(x[0]), said(x[1])))
    assert len(got) == len(expected)
    by_id = dict(texts)
    added = 0
    for r, (i, base) in zip(got, expected, strict=True):
        assert r["doc_id"] == i
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(said(base).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert set(said(base).split(",")) - {""} <= set(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        more = [s for s in spans if s.startswith("random")]
        assert len(more) == r["n_random"]
        for s in more:
            piece = by_id[i][slice(*map(int, s.split(":")[1:]))]
            assert len(piece) == 44 and i % 10 == 3
            added += 1
    assert added >= 13  # of 15 planted keys


def test_redaction(spark):
    texts = corpus()
    docs = frame(spark, texts)
    got = redact_secrets(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        if r["text"] is not None:
            assert r["n_chars"] == len(r["text"])
            assert not direct(r["text"])
    keep = {i: t for i, t in texts if t and i is not None and i < 100}
    assert all(r["text"] == keep[r["doc_id"]] for r in rows if r["doc_id"] in keep)
    assert masked("abcdefgh", [(1, 3), (2, 5), (6, 7)]) == f"a{MASK}f{MASK}h"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert scan_secrets(none).count() == 0 and redact_secrets(none).count() == 0


def test_battery():
    r = random.Random(2)
    keys = [battery(random_key(r, 44)) for _ in range(300)]
    assert sum(p < 1e-4 for p in keys) > 270
    for plain in ("internationalisationalisedcounterrevolutionaries", "abcabcabcabcabcabcabcabcabcabc", "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "0000000000111111111122222222223333333333", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        assert battery(plain) > 1e-3
    assert infer_encoding("00ff") == "hex" and infer_encoding("a+/") == "base64" and infer_encoding("é") is None


def test_runs_after_an_equals_sign(spark):
    r = random.Random(8)
    forms = ["auth={}", "?sig={}&x=1", "CLIENT_KEY={}", "DB_PASS={}", "a=={}", "averyveryverylongassignedname={}", "={}=="]
    texts = [(i, f"{words(20, i)} {forms[i % len(forms)].format(random_key(r, 64))} end") for i in range(70)]
    keys = {i: re.search("[A-Za-z0-9]{64}", t) for i, t in texts}
    found = 0
    for row in scan_secrets(frame(spark, texts)).collect():
        m, i = keys[row["doc_id"]], row["doc_id"]
        assert row["spans"] in ("", f"random:{m.start()}:{m.end() + 2 * (i % len(forms) == 6)}")
        found += row["n_random"]
    assert found >= 66
    kept = {r["doc_id"]: r["text"] for r in redact_secrets(frame(spark, texts)).collect()}
    assert sum(m.group() not in kept[i] for i, m in keys.items()) == found


ALPHABETS = {
    "hex": "0123456789abcdef", "upper hex": "0123456789ABCDEF", "mixed hex": "0123456789ABCDEFabcdef", "a-z": string.ascii_lowercase, "A-Z": string.ascii_uppercase,
    "base32": string.ascii_uppercase + "234567", "lower base32": string.ascii_lowercase + "234567", "upper alnum": string.ascii_uppercase + string.digits,
    "lower alnum": string.ascii_lowercase + string.digits, "letters": string.ascii_letters, "alnum": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/", "base64url": string.ascii_letters + string.digits + "-_",
}


@pytest.mark.parametrize("name", [*ALPHABETS, "hex of either case"])
def test_detection_rises_with_length(name):
    r = random.Random(name)

    def key(n):
        if name in ALPHABETS:
            return random_key(r, n, ALPHABETS[name])
        return "".join(r.choice((c.lower(), c.upper())) for c in random_key(r, n, "0123456789abcdef"))

    rates = [sum(battery(key(n)) < 1e-3 for _ in range(200)) / 200 for n in (20, 32, 64, 128, 256)]
    assert all(b >= a - 0.03 for a, b in zip(rates, rates[1:], strict=False)) and rates[0] < 0.9 <= rates[3] and rates[4] > 0.97, rates


def test_encodings_are_in_order_of_size():
    sizes = [len(symbols) for symbols, _ in ENCODINGS.values()]
    assert sizes == sorted(sizes) and all(len(set(symbols)) == len(symbols) for symbols, _ in ENCODINGS.values())


def test_keys_of_every_alphabet_are_found_and_words_are_not(spark):
    r = random.Random(12)
    texts = [(i, f"{words(20, i)} {random_key(r, 128, alphabet)} end") for i, alphabet in enumerate([a for n, a in ALPHABETS.items() if n != "hex"] * 10)]
    plain = [(1000 + i, f"{words(9, i)} {'Internationalisation' * 2}of2{'counterrevolutionaries' * 2} {'DEADBEEF00' * 4} 20240101000000202401020000 end") for i in range(100)]
    got = {row["doc_id"]: row["n_random"] for row in scan_secrets(frame(spark, texts + plain)).collect()}
    assert sum(got[i] for i, _ in texts) >= 0.95 * len(texts) and not any(got[i] for i, _ in plain)
