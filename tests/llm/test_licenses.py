import random

from tessera.llm import licenses as L


def brute(text, templates, t):
    grams = lambda s: (lambda w: set(w) if len(w) == 1 else {(a, b) for a, b in zip(w, w[1:], strict=False)})(L.normalised_words(s.encode()))
    paras = (text or "").split("\n\n")
    parts = [x for p in paras for x in (p.split("\n") + ([p] if "\n" in p else []))] + ([text] if len(paras) > 1 else [])
    best, n, inside = {}, 0, 0
    for u in parts:
        g, some = grams(u), False
        for name, s in templates:
            h = grams(s)
            if g and h and 2.0 * len(g & h) / (len(g) + len(h)) >= t:
                some = True
                best[name] = max(best.get(name, 0), 2.0 * len(g & h) / (len(g) + len(h)))
        n += some
    words = L.normalised_words((text or "").encode())
    for name, s in set(templates):
        m = len(L.normalised_words(s.encode()))
        h = grams(s)
        for i in range(len(words) - m + 1 if m >= L.MIN_WINDOW else 0):
            g = set(zip(words[i : i + m], words[i + 1 : i + m], strict=False))
            dice = 2.0 * len(g & h) / (len(g) + len(h))
            if dice >= t:
                inside += 1
                best[name] = max(best.get(name, 0), dice)
    top = min(best.items(), key=lambda x: (-x[1], x[0]), default=(None, 0.0))
    return top[0], top[1], n, inside, ",".join(sorted(best))


def test_matches_brute_force(spark):
    rnd = random.Random(4)
    templates = L.default_templates()
    mit = L.TEXTS["MIT"]
    texts = [None, "", "word", "Released under the MIT License.", "released UNDER the mit licence", mit, "Copyright 2020 someone\n\n" + mit + "\n\nint main() {}", mit.replace("free of charge", "gratis"), "x\n" * 3000, "a b " * 2000]
    for _ in range(80):
        words = rnd.choice(templates)[1].split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(["foo", "the", "license"])
        texts.append(rnd.choice(["", "Intro.\n", "Intro.\n\n"]) + " ".join(words) + rnd.choice(["", "\nEnd.", "\n\nEnd."]))
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {r["doc_id"]: (r["license"], r["dice"], r["n_matches"], r["n_windows"], r["licenses"]) for r in L.scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t, templates, L.THRESHOLD), i
    assert got[5][0] == "MIT" and got[6][0] == "MIT"


def test_layout_does_not_matter(spark):
    words = L.TEXTS["MIT"].split()
    third = len(words) // 3
    filler = " ".join(f"word{i}" for i in range(200))
    paragraphs = "\n\n".join(" ".join(words[i : i + third]) for i in range(0, len(words), third))
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    texts = [f"{filler}\n\n{paragraphs}\n\n{filler}", f"{filler}\n# {wrapped}\n{filler}", f"{filler} {' '.join(words)} {filler}", "See notes. Released under the MIT License. More follows here."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, filler, "the MIT people"])], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["dice"]) for r in L.scan_licenses(df).collect()}
    assert [got[i][0] for i in range(6)] == ["MIT"] * 4 + [None, None]
    assert all(got[i][1] > 0.98 for i in range(3))


def test_ties_one_word_and_empty(spark):
    df = spark.createDataFrame([(1, "alpha"), (2, "alpha beta"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in L.scan_licenses(df, templates=[("z", "Alpha"), ("y", "alpha"), ("x", "")]).collect()}
    assert got == {1: "y", 2: None, 3: None}
    assert {r["n_matches"] for r in L.scan_licenses(df, templates=[]).collect()} == {0}
    assert L.scan_licenses(df.limit(0)).count() == 0
