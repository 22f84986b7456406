import random

import numpy as np
import pyarrow as pa

from odflow.llm import secret_scan as S

BASE62 = S.ENCODINGS[5][1]


def table(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def drawn(r, alphabet, n):
    return "".join(r.choice(alphabet) for _ in range(n))


def test_a_run_counts_once_however_often_it_stands(spark):
    r = random.Random(11)
    texts = [f"see {drawn(r, BASE62, 22)} here" for _ in range(300)] + [f"see Item{i:04d}OfTheLongListX here" for i in range(300)]
    hot = next(x for x in iter(lambda: drawn(r, BASE62, 22), "") if 0.5 < S.randomness(x, BASE62) < 0.6 and S.infer_encoding(x)[0] == "base62")
    once = S.thresholds(table(spark, [*texts, hot]))
    # copies of a passage, in texts that differ
    many = S.thresholds(table(spark, [*texts, *[f"text {i}: {hot}" for i in range(5000)]]).repartition(7))
    assert many == once and "base62:20" in once


def names(n, seed=3):
    """Slugs, identifiers and paths that the null sample does not hold."""
    r = random.Random(seed)
    words = "chapter summer holiday bicycle garden window kitchen mountain river coffee doctor winter engineer picture market science".split()
    forms = ("{}-{}-{}{}", "{}_{}_{}_{}", "{}/{}/{}/{}")
    return [r.choice(forms).format(r.choice(words), r.choice(words), r.choice(words), r.randint(1, 2030)) for _ in range(n)] + [
        "".join(r.choice(words).capitalize() for _ in range(3)) + str(r.randint(1, 99)) for _ in range(n)]


def flagged(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return {r.doc_id: r.spans for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect() if r.spans}


def test_cells_without_random_strings_flag_nothing_and_a_lone_secret_is_found(spark):
    clean = [f"see {x} here" for x in names(400)]
    assert flagged(spark, clean) == {}
    r = random.Random(8)
    secrets = {"base62": drawn(r, BASE62, 32), "base64": drawn(r, S.ENCODINGS[7][1], 43), "base36": drawn(r, S.ENCODINGS[3][1], 36)}
    for least in (0.0, 0.5):      # p-values on both sides of the middle
        for name, alphabet in (("base62", BASE62), ("base64", S.ENCODINGS[7][1])):
            own = next(x for x in iter(lambda: drawn(r, alphabet, 32), "") if 0.02 < S.randomness(x, alphabet) - least < 0.5 and S.infer_encoding(x)[0] == name)
            assert flagged(spark, [f"see {own} here"]) == {0: "random:4:36"}
            assert flagged(spark, [*clean, f"see {own} here"]) == {800: "random:4:36"}
    assert set(flagged(spark, [*clean, *[f"see {x} here" for x in secrets.values()]])) == {800, 801, 802}


def test_short_runs_need_more_evidence_than_long_ones():
    assert all(np.all(np.diff(S.null_of(k)) >= 0) for k in ("base62:16", "base64:40"))
    assert S.null_of("base62:16")[8] > S.null_of("base62:24")[8] > S.null_of("base62:40")[8]
    # many different names with a p-value seen among names: no discovery
    names_only, few = np.zeros(S.BINS, np.int64), np.zeros(S.BINS, np.int64)
    names_only[[4, 60]], few[4] = (2, 998), 1
    assert S.stepped_up({"base62:16": names_only}, S.FDR) == {}
    # one run of an encoding alone, or next to a sparse class of names
    assert S.stepped_up({"base62:40": few}, S.FDR)["base62:40"] <= S.EDGES[4]
    near = np.zeros(S.BINS, np.int64)
    near[60] = 30
    pool, = S.pools({"base62:32": near, "base62:40": few})
    assert S.stepped_up(pool, S.FDR)["base62:40"] <= S.EDGES[4]


def test_parts_of_mixed_runs_and_runs_without_digits_are_tested(spark):
    r = random.Random(21)
    url, plain = S.ENCODINGS[7][1], S.ENCODINGS[6][1]
    token = next(x for x in iter(lambda: drawn(r, url, 40), "") if "-" in x[1:-1] and "_" in x[1:-1])
    standard = next(x for x in iter(lambda: drawn(r, plain, 44), "") if "+" in x[1:-1] and "/" in x[1:-1])
    letters = drawn(r, S._LOWER + S._LOWER.upper(), 24)
    texts = [f"get /api_v1/{token} now", f"with my-key/{standard}.", f"or {letters} here", "but InternationalizationOfTheWorld and /usr_local/share-doc/readme_first/of-all"]
    got = flagged(spark, texts)
    assert got[0] == "random:12:52"
    # the part's own alphabet holds the slash before it
    assert got[1] == "random:8:56"
    assert got[2] == "random:3:27"
    assert 3 not in got


def test_runs_without_digits():
    assert S.infer_encoding("Internationalization") is S.infer_encoding("some_long_identifier") is S.infer_encoding("UPPER_CASE_CONSTANT") is None
    assert S.infer_encoding("qWeRtYuIoPaSdFgHjK")[0] == "base62"
    assert S.candidates("Some/long-path/without/anything-else") == []
    scanner = S.Scanner()
    texts = ["Internationalization Qwertyuiopasdfghjkl UPPERCASEUPPERCASE qwertyuiopAsdfghjkl", "aaaaaaaaaaaaaaaaaaaB"]
    runs = [x for _, data, offsets in S.stretches(pa.array(texts)) for _, _, _, found in scanner.stretch(data, offsets, False) for _, _, x in found]
    assert runs == ["qwertyuiopAsdfghjkl", "aaaaaaaaaaaaaaaaaaaB"]


def test_neighbours_outside_ascii(spark):
    own = drawn(random.Random(31), BASE62, 32)
    clean = ["\u201c{}\u201d", "\u00ab{}\u00bb", "\u2026{}\u2014", "\uff1a{}\u3002", "\u6f22{}\u5b57", "\u00a0{}\u2009", "\u043a\u043b\u044e\u0447{}", "\U0001f511{}\U0001f511", "{}\u201d", "\u201c{}"]
    joined = ["\u00e9{}", "{}\u00df", "\u201c{}\u0142", "{}\u0301"]
    got = flagged(spark, [x.format(own) for x in [*clean, *joined]])
    assert got == {i: f"random:{x.index('{')}:{x.index('{') + 32}" for i, x in enumerate(clean)}
    assert not any(map(S.continues, ["", "a", " ", "\u201c", "\u5b57", "\u00aa", "\ud7ff"]))
