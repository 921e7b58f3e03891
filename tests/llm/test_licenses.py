"""License scans against a plain version, on planted notices and odd tables."""

import re

from longtrace.llm import licenses

MIT = dict(licenses.NOTICES)["mit"]
ANY = "doc_id long, text string"


def cut(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text, phrases=licenses.PHRASES, notices=licenses.NOTICES, gram=3, shift=3, share=0.75, stretch=2.0):
    words, base, best = cut(text), [], []
    for label, phrase in phrases:
        p = cut(phrase)
        base += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    for label, notice in notices:
        t = cut(notice)
        k = min(gram, len(t))
        hits = sorted((i - j, i, j) for j in range(len(t) - k + 1) for i in range(len(words) - k + 1) if words[i : i + k] == t[j : j + k])
        bands = []
        for d, i, j in hits:
            if not bands or d - bands[-1][-1][0] > shift:
                bands.append([])
            bands[-1].append((d, i, j))
        for band in bands:
            got = len({j + x for _, _, j in band for x in range(k)}) / len(t)
            if got >= share and max(i for _, i, _ in band) + k - min(i for _, i, _ in band) <= stretch * len(t):
                best.append((got, label))
    starts = [i for i, _ in base]
    names = {x for _, x in base}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(names)), ",".join(sorted(names | {x for _, x in best})), max([1.0] * bool(base) + [x for x, _ in best], default=0.0))


def scanned(df, **kw):
    return sorted(((r[0], tuple(r[1:])) for r in licenses.license_scan(df, **kw).collect()), key=str)


TEXTS = [
    None,
    "",
    "  --  ",
    "mit",
    "MIT license, MIT License; mit-license",
    MIT,
    MIT.replace("free of charge", "wholly free of any charge").replace("sublicense", ""),
    " ".join(f"{w} zz" for w in cut(MIT)),
    "x " * 3000 + "Licensed under CC BY-NC 4.0." + " y" * 3000 + " licensed under CC BY-NC 4.0. gnu general public license",
    "Licensed under CC BY 4.0, the apache license and the gnu general general public license",
    "licensed under the licensed under the apache apache license version 2.0",
    "İMIT LICENSE mit ﬁ license",
    "mit license " * 500,
    "\u212aey PERMISSION \u0130s mit licen\u017fe apache\u00a0license",
]


def test_matches_a_plain_scan(spark):
    rows = list(enumerate(TEXTS)) + [(None, MIT), (5, MIT), (5, MIT), (5, "mit license")]
    df = spark.createDataFrame([(i, t, i, t) for i, t in rows], "doc_id long, text string, n int, label string")
    want = sorted(((i, plain(t)) for i, t in rows), key=str)
    assert scanned(df) == want
    assert scanned(df, block_grams=20) == want


def test_edited_notices_are_found_and_scattered_words_are_not(spark):
    got = dict(scanned(spark.createDataFrame([(i, TEXTS[i]) for i in (6, 7)], ANY)))
    assert "mit" in got[6][5].split(",") and 0.75 <= got[6][6] < 1
    assert got[7][5:] == ("", 0.0)


def test_own_templates_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "Alpha beta, gamma delta!"), (2, "beta")], ANY)
    own = spark.createDataFrame([("a", "alpha beta gamma", True), ("b", "BETA", True), ("c", "alpha beta gamma delta epsilon", False), ("none", "--", True)], "label string, text string, exact boolean")
    assert scanned(docs, templates=own) == [(1, (4, 2, 0, 1, "a,b", "a,b,c", 1.0)), (2, (1, 1, 0, 0, "b", "b", 1.0))]
    assert scanned(docs, templates=own.limit(0)) == [(1, (4, 0, None, None, "", "", 0.0)), (2, (1, 0, None, None, "", "", 0.0))]
    assert scanned(docs.limit(0)) == []


def test_plan_has_no_python(spark):
    plan = licenses.license_scan(spark.createDataFrame([], ANY))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
