import random
import re
import time

from tidemark.llm import secrets_forest as s


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    rows, secret = [], set()
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(60))
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        kind = i % 6
        if kind == 0:
            text += f' token = "{value}"'
        elif kind == 1:
            text += f" see http://example.org/{value[:24]}/page"
        elif kind == 2:
            text += " " + "".join(rng.choice(words) for _ in range(6))
        elif kind == 3:
            text += " number " + "".join(rng.choice("0123456789") for _ in range(24))
        start = re.search(r"[A-Za-z0-9+/_=-]{20,}", text)
        if kind == 0:
            secret.add((i, start.start()))
        rows.append((i, "é " + text if i % 2 else text, "en", "s"))
    return rows, {(i, at + 2 if i % 2 else at) for i, at in secret}


def test_forest_removes_false_positives(docs_of):
    rows, secret = corpus()
    got = s.scan(docs_of(rows).select("doc_id", "text")).collect()
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        assert texts[r.doc_id][r.start:r.start + r.length].encode() == bytes(r.value)
    assert {(r.doc_id, r.start) for r in got if r.is_secret} == secret
    assert len(got) > len(secret) + 100


def test_given_labels_decide(docs_of, spark):
    rows, secret = corpus()
    df = docs_of(rows).select("doc_id", "text")
    marks = [(r.doc_id, r.start, 1 - int((r.doc_id, r.start) in secret)) for r in s.scan(df).collect()]
    labelled = spark.createDataFrame(marks + [(10**6, 1, 1)], "doc_id long, start long, label int")
    flagged = {(r.doc_id, r.start) for r in s.scan(df, labelled).collect() if r.is_secret}
    assert flagged == {(i, at) for i, at, label in marks if label}


def test_edges(docs_of, edge_rows):
    rows = edge_rows + [(70, "x" * 200_000, "en", "s"), (71, "é" * 30 + "A1b2" * 6 + "=", "en", "s")]
    got = s.scan(docs_of(rows).select("doc_id", "text")).collect()
    assert {(r.doc_id, r.start, r.length) for r in got} == {
        (15, 0, 5000), (70, 0, 200_000), (71, 30, 25)}
    assert not any(r.is_secret for r in got)
    assert s.scan(docs_of([]).select("doc_id", "text")).count() == 0


def test_query_finds_planted_tokens(spark):
    sf = "/root/testdata/sf0.01"
    want = {(r.doc_id, m.start(1)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()
            for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r.text or "")}
    assert want == {(r.doc_id, r.start) for r in s.op2_secrets_forest(spark, sf).collect() if r.is_secret}


def test_short_and_odd_secrets_are_candidates():
    cases = {
        'password = "S3cr3t!pass"': "S3cr3t!pass", 'api_key = "AKIA1234567890AB"': "AKIA1234567890AB",
        "see postgres://u:p4ss@h/db now": "p4ss", 'token = "Abc123.def456.ghi789.jkl"': "Abc123.def456.ghi789.jkl",
        "AUTH_TOKEN: x9": "x9", "client_secret='a b c'": "a b c", "é é passwd=ü1ß;": "ü1ß",
    }
    scanner = s.Scanner({b"word": 3})
    for text, value in cases.items():
        raw = text.encode()
        assert [raw[a:b].decode() for a, b in s.candidates(raw)] == [value]
        (start, length, found, measures, _), = scanner.scan(raw)
        assert text[start:start + length] == value == found.decode() and len(measures) == len(s.MEASURES)
    assert s.candidates(b"tokens are words, and so is a short run abc123") == []


def test_candidates_do_not_overlap():
    run = b"A1b2C3d4" * 4
    text = b'token = "' + run + b'!" ' + run + b" x://u:" + run + b"@h " + run
    spans = s.candidates(text)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert [text[a:b] for a, b in spans] == [run + b"!", run, run, run]


def test_long_text_without_spaces_takes_linear_time():
    scanner, took = s.Scanner({b"word": 3}), []
    for lines in (4_000, 16_000):
        text = "\n".join(f"{i * 2654435761 % 2**160:040x}" for i in range(lines)).encode()
        start = time.perf_counter()
        assert sum(1 for _ in scanner.scan(text)) == lines
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0]
    for text in (b"token" * 200_000, b"://" * 200_000, b'token="' * 100_000):
        start = time.perf_counter()
        s.candidates(text)
        assert time.perf_counter() - start < 20


def test_labels_are_not_made_from_features():
    assert not set(s.LABEL_GIVING) & set(s.FEATURES) and set(s.LABEL_GIVING) < set(s.MEASURES)


def test_secrets_that_the_rule_cannot_see(docs_of):
    """Unquoted values are not labelled by the rule; the forest tells them from paths and words by their looks."""
    rows, secret = corpus()
    rng = random.Random(9)
    extra = {}
    for i in range(1000, 1040):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        extra[i] = f"some words before token = {value} and after"
    got = s.scan(docs_of(rows + [(i, t, "en", "s") for i, t in extra.items()]).select("doc_id", "text")).collect()
    flagged = {r.doc_id for r in got if r.is_secret}
    assert len(flagged & set(extra)) >= 36
    assert {d for d in flagged if d < 1000} == {i for i, _ in secret}
