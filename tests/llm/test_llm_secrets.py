import hashlib
import random
import re

import numpy as np
from llm_texts import rows_of

from loglens.llm import secret_scan as S

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def secret(rng, n, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    return "".join(rng.choice(letters) for _ in range(n))


def texts():
    rng = random.Random(3)
    out = [None, "", "passwort: abc", "token: short", "secret:token:abcdefgh", "TOKEN = 'abcdef'", "Größe password=\"ab12cd34\" é",
           "ſecret=abcdefghij toKen=abcdefghij", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAKIA" + "Z" * 14, "f" * 24, "f" * 23,
           "g" + "0123456789abcdef" * 2 + "G", "api_key:  x.y=z/w apikey=1234567", "token=token=abcdefgh", "x" * 20000]
    for _ in range(150):
        out.append(" ".join(["the ordinary identifier_names are_common here", f'token = "{secret(rng, 40, "0123456789abcdef")}"',
                             f"password={secret(rng, 24)}", "some_function_name and/or another_variable_name"]))
    return out


def test_pattern_spans_digest_and_model_spans(spark, docs, table_dir):
    rng = random.Random(8)
    extra = ["call " + secret(rng, 36) + " now", "the ordinary_identifier_names_are_common_here"]
    some = [*texts(), *extra]
    got = {r.doc_id: r for r in S.QUERIES["op10_secret_scan"](spark, table_dir(documents=docs(some))).collect()}
    for i, t in enumerate(some):
        spans = base_spans(t)
        text = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, k, _ in spans) for x in range(3)]
        every = [s.split(":") for s in got[i].spans.split(",") if s]
        assert [s for s in every if s[0] != "markov"] == [[S.KINDS[k], str(a), str(b)] for a, k, b in spans]
        assert every == sorted(every, key=lambda s: (int(s[1]), S.KINDS.index(s[0])))
    assert got[len(some) - 2].spans == "markov:5:41" and got[len(some) - 1].spans == ""


def test_redaction_replaces_every_span(docs):
    some = texts()
    df = docs(some)
    models = S.MarkovModels.train(S.sample_counts(df))
    rows = {r.doc_id: r for r in S.redact(df, models).collect()}
    spans = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in S.find_secrets(df, models).collect()}
    for i, t in enumerate(some):
        want, at = "", 0
        assert [(a, S.KINDS.index(k), b) for a, k, b in spans[i] if k != "markov"] == base_spans(t)
        for a, _, b in spans[i]:
            if a >= at:
                want += (t or "")[at:a] + S.MARK
            at = max(at, b)
        want = None if t is None else want + t[at:]
        assert rows[i].text == want
        assert rows[i].n_chars == len(want or "")


def test_empty_table_clashing_columns_and_null_ids(spark, docs):
    df = spark.createDataFrame([(None, "f" * 30, 1), (1, None, 2), (1, None, 2)], "doc_id long, text string, spans int")
    models = S.MarkovModels.train(S.sample_counts(df))
    got = sorted((str(r.doc_id), len(r.spans)) for r in S.find_secrets(df, models).collect())
    assert got == [("1", 0), ("1", 0), ("None", 1)]
    assert S.redact(df, models).columns == df.columns
    empty = docs([])
    assert S.find_secrets(empty, S.MarkovModels.train(S.sample_counts(empty))).collect() == []


def test_counts_cover_every_token(docs):
    counts = {r.cell: (r.random, r.ordinary) for r in S.sample_counts(docs(rows_of(["ab ab", "b token=abcdef"]))).collect()}
    cell = lambda x, y: (S.START if x is None else S.ALPHABET.index(x)) * S.SIZE + S.ALPHABET.index(y)
    assert counts[cell(b"a", b"b")] == (1, 2)
    assert counts[cell(None, b"b")] == (0, 1)
    assert counts[cell(b"e", b"f")] == (1, 0)


def brute_parts(gain):
    """The first part by trying all: the one that exceeds the rate most, of MIN_TOKEN characters or, if that misses the ratio, of MIN_RATIO / MIN_RATE."""
    n = len(gain)
    for least in (S.MIN_TOKEN, int(S.MIN_RATIO / S.MIN_RATE)):
        all_parts = [(sum(gain[x:y]) - S.MIN_RATE * (y - x), x, y) for x in range(n) for y in range(x + least, n + 1)]
        if not all_parts or max(all_parts)[0] < 0:
            return None
        over = max(all_parts)[0]
        x, y = next((x, y) for o, x, y in sorted(all_parts, key=lambda p: p[2]) if o > over - 1e-9)
        if sum(gain[x:y]) >= S.MIN_RATIO:
            return x, y
    return None


def test_random_parts_equal_brute_force():
    rng = np.random.default_rng(4)
    some = 0
    for _ in range(300):
        gain = rng.normal(-0.6, 1.2, rng.integers(1, 90))
        if rng.random() < 0.7 and len(gain) > 25:
            at = rng.integers(0, len(gain) - 20)
            gain[at:at + rng.integers(18, 45)] += 1.9
        got, want = S.random_parts(gain), brute_parts(gain.tolist())
        some += want is not None
        assert (got[0] if got else None) == want
        for x, y in got:
            assert y - x >= S.MIN_TOKEN and gain[x:y].sum() >= S.MIN_RATIO and gain[x:y].mean() >= S.MIN_RATE
        assert all(a[1] <= b[0] for a, b in zip(sorted(got), sorted(got)[1:]))
    assert 50 < some < 250


def test_keys_of_one_class_in_paths_behind_names_and_beside_patterns(docs):
    rng = random.Random(5)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    plain = [" ".join(["the ordinary identifier_names_are_common_here and/or another_variable_name", f"password={secret(rng, 24)}",
                       f"secret={secret(rng, 32, low)}", f"token={secret(rng, 32, up)}"]) for _ in range(4000)]
    a, b, c, d, e = secret(rng, 32, low), secret(rng, 32, up), secret(rng, 24), secret(rng, 22), secret(rng, 30, up + digits)
    found = [f"x {a} y", f"x {b} y", f"see another_variable_name/ordinary/{c}/identifier_names/common now", f"long_setting_name_for_service={d}",
             f"{'0123456789abcdef' * 2}{e.replace('A', 'Z')}", f"{a}\u00e9{b}"]
    clean = ["the ordinary identifier_names_are_common_here", "another_variable_name/ordinary/identifier_names_are_common"]
    df = docs([*plain, *found, *clean])
    models = S.MarkovModels.train(S.sample_counts(df))
    rows = {r.doc_id: r.spans for r in S.find_secrets(df, models).collect()}
    spans = [[(found[i][s.start:s.end], s.kind) for s in rows[len(plain) + i]] for i in range(len(found))]
    share = lambda key, got: max((len(t) for t, k in got if k == "markov" and (t in key or key in t)), default=0) / len(key)
    for key, got in zip((a, b, c, d, e.replace("A", "Z"), a), spans, strict=True):
        assert share(key, got) >= 0.8, (key, got)
    assert share(b, spans[5]) >= 0.8
    assert all(not rows[len(plain) + len(found) + i] for i in range(len(clean)))
    assert spans[4][0][1] == "hex"


def test_a_very_long_text(docs):
    rng = random.Random(6)
    plain = [f"the ordinary identifier_names_are_common_here password={secret(rng, 24)}" for _ in range(200)]
    key = secret(rng, 40)
    long = "identifier_names_are_common " * 150_000 + key + " end" + "/ordinary_identifier" * 50_000
    df = docs([*plain, long])
    (row,) = S.find_secrets(df, S.MarkovModels.train(S.sample_counts(df))).where(f"doc_id = {len(plain)}").collect()
    assert [long[s.start:s.end] for s in row.spans] == [key]
