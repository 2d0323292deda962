import base64
import random
import re
from collections import Counter

import zstandard
from tessera.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        dup,
        len(inside),
        n < 50 or 100 * len(inside) > 50 * n,
    )


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_base_counts_and_bands(spark):
    rnd = random.Random(1)
    natural = " ".join(rnd.choice(["the", "of", "and", "river", "town", "people", "market", "winter", "garden", "letter", "window", "silver"]) + rnd.choice(["", "s", "ed", ",", "."]) for _ in range(400))
    noise = " ".join("".join(chr(rnd.randint(33, 126)) for _ in range(20)) for _ in range(300))
    phrase = prose(rnd, 40)
    texts = [None, "", " \n\t ", "one two", "a b c a b c", "x\ny\nx\n\nx \n#*$", "tab\x0bfeed\x0cnbsp\u00a0joined", "é ü " * 30, prose(rnd, 60), prose(rnd, 5000) + "\n", natural, noise, natural, phrase + " " + " ".join(phrase[:9] + str(i) for i in range(80)), "w " * 200_000]
    df = spark.createDataFrame([(i, t, "clash", True) for i, t in enumerate(texts)], "doc_id long, text string, ratio string, kept boolean")
    out = {r["doc_id"]: r for r in quality.compression_bands(df).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t), i
        assert not (r["base_failed"] and r["kept"])
        assert r["text"] == t
    assert out[11]["reason"] == "incompressible"
    assert out[10]["n_words"] == out[12]["n_words"] and out[10]["kept"] == out[12]["kept"]


def test_ratios_and_length_bands():
    import zstandard

    z = zstandard.ZstdCompressor(level=3)
    p = quality.QualityParams()
    ok, ratio, *_ = quality.verdict(b"abcd" * 5000, p, z)
    assert not ok and ratio < 0.05
    assert [quality.band_of(n, quality.WHOLE_BANDS).below for n in (1, 511, 512, 10**9)] == [512, 512, 1024, float("inf")]


def test_encoded_tail_shorter_than_a_chunk():
    rnd = random.Random(3)
    z, p = zstandard.ZstdCompressor(level=3), quality.QualityParams()
    vocabulary = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 7))) for _ in range(250)]
    plain = 0
    for _ in range(30):
        text = b""
        while len(text) < 2200:
            text += rnd.choice(vocabulary).encode() + b" "
        if not quality.verdict(text, p, z)[0]:
            continue
        plain += 1
        ok, ratio, _, high, bad, reason = quality.verdict(text + base64.b64encode(rnd.randbytes(1275)), p, z)
        assert (ok, reason, bad) == (False, "chunks", 1) and ratio <= 0.70 < high
        # Whole chunks alone have no further tail.
        assert quality.verdict(text[:2048], p, z)[2] == quality.verdict(text[:2048], p, z)[3]
    assert plain >= 20


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, `a.b` int, text string")
    assert quality.compression_bands(df).count() == 0
    assert quality.keep_good(df).columns == df.columns


def test_long_windows_of_many_words():
    words = [str(i).encode() for i in range(3_000_000 // 10)] + [b"1", b"2", b"3"]
    assert quality.repeat_words(words) == 6
