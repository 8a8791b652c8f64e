import hashlib
import random
import re

from shortbook.llm import secrets as S
from shortbook.llm.queries import QUERIES


def brute(text):
    """Base spans by the plain patterns, without the shortcuts."""
    text = text or ""
    spans = []
    for k, (_, pattern, group, least) in enumerate(S.BASE_PATTERNS):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                spans.append((m.start(), k, m.end()))
    return sorted(spans)


def test_whole_table_matches_brute_force(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op1_secret_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = brute(d.text)
        r = got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(S.join_spans(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(S.join_spans(base).split(",")) <= set(r.spans.split(","))


def test_short_match_is_consumed_before_the_next():
    # the first match takes "token" (5 characters) and fails; the rest has no keyword left
    assert S.base_spans("token: token: abcdefgh") == brute("token: token: abcdefgh") == []
    text = 'Passwd="abc123xyz" ſecret=abcdefgh AKIA' + "A" * 16 + " AKIA" + "B" * 15
    assert S.base_spans(text) == brute(text)
    assert len(S.base_spans(text)) == 2


def test_random_strings_are_found_and_identifiers_are_not():
    enc = S.encoding(S.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    found = 0
    for _ in range(200):
        key = "".join(rnd.choice(alphabet) for _ in range(32))
        found += bool(S.random_spans(f"the key {key} is here", [], enc))
    assert found >= 190
    plain = ["averyLongCamelCaseIdentifierName", "SOME_CONSTANT_NAME_HERE", "lichlichlichschlichachch",
             "6171267541720037", "d41d8cd98f00b204e9800998ecf8427e",
             "123e4567-e89b-12d3-a456-426614174000", "https/www/example/org/index"]
    for s in plain:
        assert S.random_spans(f"see {s} there", [], enc) == [], s


def test_runs_without_digits_and_keys_beside_words():
    enc = S.encoding(S.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(7)
    lower = "abcdefghijklmnopqrstuvwxyz"
    draw = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    for alphabet in (lower, lower.upper(), lower + lower.upper()):
        for size in (16, 24):
            assert sum(bool(S.random_spans(f"key {draw(alphabet, size)}.", [], enc)) for _ in range(200)) >= 188
    found = {}
    for before, size in (("https_path/documentation/configuration/", 20), ("https_path/documentation/configuration/", 32),
                         ("documentation_configuration_", 32), ("the/path/to=configuration_value=", 20)):
        for _ in range(200):
            key = draw(lower + lower.upper() + "0123456789", size)
            spans = S.random_spans(f"see {before}{key} there", [], enc)
            found[before, size] = found.get((before, size), 0) + any(e == 4 + len(before) + size for _, _, e in spans)
    assert min(found.values()) >= 190
    # beside a base span in the same run, each character in one span at most
    text = "0123456789abcdef01234567/kQ8vZr3TnXw7LmYb2Jd5 x"
    assert S.random_spans(text, S.base_spans(text), enc) == [(25, 3, 45)]
    for s in ("MAX_CHARS_PER_TOKEN", "internationalization", "Donaudampfschifffahrtsgesellschaft",
              "configuration/documentation=some_value_of_words"):
        assert S.random_spans(f"see {s} there", [], enc) == [], s


def test_edges(spark):
    long = "word " * 200_000 + "AKIA" + "Q7" * 8
    df = spark.createDataFrame(
        [(1, None, "x", None), (1, "", "x", None), (None, "secret=abcdef", "y", 1), (4, long, None, 2)],
        "doc_id long, text string, spans string, n_hex int")
    rows = S.find_secrets(df).collect()
    assert len(rows) == 4
    empty = hashlib.sha256(b"").hexdigest()
    assert [r.base_sha256 for r in rows[:2]] == [empty, empty]
    assert rows[2].spans == "assign:0:13"
    assert rows[3].spans == "access:1000000:1000020"
    assert S.find_secrets(df.limit(0)).collect() == []
