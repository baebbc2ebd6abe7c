"""Operators on texts against brute force, exact round trips and small awkward tables."""

import hashlib
import random
import time
import re
import zlib
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from apportion.llm import decontaminate, html, langid, media, pieces, quality, secrets, simhash, wordpiece

ODD = [(1, "A b c d e f g"), (1, "A b c d e f g"), (2, None), (3, ""), (4, " \t\n\x0b"), (None, "no id here at all"), (5, "x" * 70_000), (6, "é ▁ \U0001f600 中文 \x00"), (7, "tie tie tie tie")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(i, t, 0.5, -1, "s") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, component_id int, fingerprint string").repartition(2)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


# Media columns.


@pytest.mark.parametrize("n", [1, 63, 64, 150, 162, 163, 170, 4032, 4096, 4160, 12_352, 100_000])
def test_streams_come_back(n):
    data = random.Random(n).randbytes(n)
    stream = media.mux_bytes(data)
    found = media.demux_bytes(stream)
    assert len(stream) % 188 == 0 and found["samples"].tobytes() == data and found["gaps"] == 0
    assert [u[0] for u in found["units"]] == [k * 46_080 for k in range(len(found["units"]))]
    assert all(u[3] for u in found["units"])


def test_lost_and_broken_packets_show():
    stream = media.mux_bytes(bytes(range(256)) * 40)
    assert media.demux_bytes(stream[: 188 * 5] + stream[188 * 6 :])["gaps"] == 1
    twice = media.demux_bytes(stream[: 188 * 6] + stream[188 * 5 :])
    assert twice["gaps"] == 0 and bytes(twice["samples"]) == bytes(range(256)) * 40
    thrice = media.demux_bytes(stream[: 188 * 6] + stream[188 * 5 : 188 * 6] * 2 + stream[188 * 6 :])
    assert thrice["gaps"] == 1
    # The packet that begins a unit has an adaptation field; its discontinuity flag allows a jump of the counter.
    first = next(k for k in range(3, len(stream) // 188) if stream[188 * k + 1] & 0x40 and stream[188 * k + 3] & 0x20)
    jump = bytearray(stream[: 188 * (first - 1)] + stream[188 * first :])
    assert media.demux_bytes(bytes(jump))["gaps"] == 1
    jump[188 * (first - 1) + 5] |= 0x80
    assert media.demux_bytes(bytes(jump))["gaps"] == 0
    for bad in (b"", stream[:-1], b"\0" + stream[1:], stream[:20] + b"\xff" + stream[21:]):
        with pytest.raises(ValueError):
            media.demux_bytes(bad)


def test_media_rows(odd, empty):
    rows = media.demux(media.mux(odd)).collect()
    assert len(rows) == len(ODD)
    want = sorted((str(i), len(raw := (t or "").encode()), hashlib.sha256(p := raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")).hexdigest(), zlib.crc32(p[-64:])) for i, t in ODD)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
    assert media.demux(media.mux(empty)).count() == 0


# Secrets.


def plain_spans(text):
    rules = [(r"""((?:%s))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""" % "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")), 2, 12), (r"AKIA[A-Z0-9]+", 0, 18), (r"[0-9a-f]+", 0, 16)]
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(rules) for m in re.finditer(p, text) if len(m.group(g)) >= n)


def test_spans_against_plain_rules():
    r = random.Random(3)
    words = ["password", "TOKEN", "Api_Key", "secret", ":", "=", " ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "zz", "/+", "ſecret", "passwd=abcdefghijklmnop", "é"]
    for _ in range(2000):
        text = "".join(r.choices(words, k=r.randint(0, 14)))
        assert [(a, secrets.KINDS.index(k), b) for k, a, b in secrets.find_spans(text) if k != "pem"] == plain_spans(text)


def test_the_ledger_scans_a_blob_once(spark, odd, empty):
    docs = spark.createDataFrame([(1, "token=abcdefghijklmnop"), (2, "token=abcdefghijklmnop"), (3, "plain")], "doc_id long, text string")
    ledger = secrets.scan(docs).cache()
    assert ledger.count() == 2
    more = docs.union(spark.createDataFrame([(4, "AKIA" + "B" * 16)], docs.schema))
    new = secrets.scan(more, ledger)
    assert new.count() == 1 and secrets.scan(more, ledger, rule_version="next").count() == 3
    found = {r["path"]: len(r["spans"]) for r in secrets.findings(more, ledger.union(new)).collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 1}
    assert {r["text"] for r in secrets.redact(more, ledger.union(new)).collect()} == {"[REDACTED]", "plain"}
    assert secrets.findings(odd, secrets.scan(odd)).count() == len(ODD)
    assert secrets.redact(odd, secrets.scan(odd)).columns == odd.columns
    assert secrets.scan(empty).count() == 0


def test_ledger_is_stored_and_scans_new_blobs_only(spark, tmp_path, monkeypatch):
    folder, key = str(tmp_path / "ledger"), "AKIA" + "A" * 16
    first = spark.createDataFrame([(1, f"a {key}"), (2, "plain"), (3, f"a {key}"), (None, None)], "doc_id long, text string")
    second = spark.createDataFrame([(1, f"a {key} moved"), (2, "plain"), (4, f"a {key}"), (5, "")], "doc_id long, text string")
    assert secrets.read_ledger(spark, folder) is None
    assert secrets.update(first, folder).count() == 3
    ledger = secrets.read_ledger(spark, folder)
    assert secrets.unseen(second, ledger).count() == 1 and secrets.scan(second, ledger).count() == 1
    monkeypatch.setattr(secrets, "find_spans", lambda text: 1 / 0)  # known blobs are not scanned again
    assert secrets.scan(first, ledger).count() == 0
    monkeypatch.undo()
    assert secrets.update(second, folder).count() == 4
    assert secrets.update(second, folder, rule_version="next").count() == 4 + 4
    found = sorted((r["path"], len(r["spans"])) for r in secrets.findings(second, secrets.read_ledger(spark, folder)).collect())
    assert found == [(1, 1), (2, 0), (4, 1), (5, 0)]


def test_redact_keeps_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "AKIA" + "A" * 16, "b", "s", 7), (2, "plain", "c", "t", 8)], "doc_id long, text string, __blob string, __spans string, __salt int")
    got = sorted(tuple(r) for r in secrets.redact(docs, secrets.scan(docs)).collect())
    assert got == [(1, "[REDACTED]", "b", "s", 7), (2, "plain", "c", "t", 8)]


# Token counts.


def test_counts_against_greedy_matching(odd, empty):
    def greedy(initial, continuing, word):
        n = i = 0
        while i < len(word):
            own = initial if i == 0 else continuing
            j = next((j for j in range(len(word), i, -1) if word[i:j] in own), 0)
            if not j:
                return 1
            n, i = n + 1, j
        return n

    for seed in range(150):
        r = random.Random(seed)
        make = lambda: {"".join(r.choices("abc", k=r.randint(1, 5))) for _ in range(r.randint(1, 12))}
        a, b = make(), make()
        automaton = wordpiece.Automaton(sorted(a), sorted(b))
        for _ in range(60):
            w = "".join(r.choices("abcd", [5, 5, 5, 1], k=r.randint(1, 14)))
            assert automaton.count(w) == greedy(a, b, w)
    rows = wordpiece.token_counts(odd, ["tie", "A"], ["b"]).collect()
    assert sorted((str(x[0]), x[1], x[2]) for x in rows) == sorted((str(i), len((t or "").encode().split()), len((t or "").encode().split())) for i, t in ODD)
    assert wordpiece.token_counts(empty, ["a"], []).count() == 0


# SimHash.


def plain_components(rows):
    fps = simhash.fingerprints([t or "" for _, t in rows])
    left, right = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    root = simhash._roots(len(rows), left, right)
    least = {}
    for (i, _), r in zip(rows, root.tolist(), strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted((str(i), f"{int(f):016x}", least.get(r)) for (i, _), f, r in zip(rows, fps, root.tolist(), strict=True))


def test_fingerprint_by_its_definition():
    import xxhash

    text = "The cat SAT on\tthe mat É the cat sat"
    words = "the cat sat on the mat É the cat sat".split()
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(len(words) - 2)]
    assert int(simhash.fingerprints([text])[0]) == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("few", [0, simhash.FEW])
def test_near_duplicates_against_all_pairs(spark, odd, empty, monkeypatch, few):
    monkeypatch.setattr(simhash, "FEW", few)
    r = random.Random(1)
    base = [f"w{r.randint(0, 400)}" for _ in range(300)]
    rows = list(ODD)
    for k in range(120):
        own = list(base)
        for _ in range(k % 5):
            own[r.randrange(300)] = "changed"
        rows.append((100 + k, " ".join(own)))
    rows += [(1000 + k, " ".join(f"v{r.randint(0, 99)}" for _ in range(40))) for k in range(60)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x["doc_id"]), x["fingerprint"], x["component_id"]) for x in got) == plain_components(rows)
    kept = simhash.representatives(odd).collect()
    assert sorted(str(x["doc_id"]) for x in kept) == ["1", "2", "5", "6", "7", "None"]
    assert simhash.representatives(odd).columns == odd.columns
    assert simhash.near_duplicates(empty).count() == 0 and simhash.representatives(empty).count() == 0


def test_a_repeated_id_stands_in_each_of_its_components(spark):
    a, b, c = ("".join(random.Random(k).choices("abcdefgh ", k=400)) for k in range(3))
    docs = spark.createDataFrame([(1, c), (5, a), (5, b), (5, b), (5, c), (7, a), (8, b), (None, a)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.representatives(docs).collect())
    assert got == sorted([(1, c), (5, a), (5, b)])


def test_long_lists_give_the_parts_of_short_ones(monkeypatch):
    r = np.random.default_rng(2)
    for position in (0, 17, 34):
        mask = simhash.MASKS[position]
        free = [b for b in range(64) if not mask >> b & 1]
        for bits in (free[:10], free[8:18], free):
            fps = np.unique(np.array([sum(1 << int(b) for b, x in zip(bits, r.integers(0, 2, len(bits))) if x) for _ in range(300)], dtype=np.uint64))
            monkeypatch.setattr(simhash, "SMALL", 2048)
            short = simhash._pairs(fps)
            assert (simhash._split(fps, mask) == short).all()
            monkeypatch.setattr(simhash, "SMALL", 40)
            if bits is not free:
                assert (simhash._split(fps, mask) == short).all()


def test_the_tally_rejects_pairs_that_share_a_list():
    # Four of the first seven bytes are equal, so the two meet in a list; no fifth byte is.
    a, b = np.uint64(0x11), np.uint64(0x11) ^ np.uint64(0x0101010100000000)
    assert sum(int(a) & m == int(b) & m for m in simhash.MASKS) == 1 and int(a ^ b).bit_count() == 4
    shared = (np.array([a ^ b]).view(np.uint8) == 0).sum()
    assert shared == simhash.MATCHES - 1 and simhash._pairs(np.array([a, b])).tolist() == [0, 1]
    # Any two within three bits meet in at least one list.
    for bits in ((0, 1, 2), (0, 8, 16), (7, 55, 63), (5,), (40, 41, 63)):
        c = int(a) ^ sum(1 << x for x in bits)
        assert any(int(a) & m == c & m for m in simhash.MASKS)


def test_hot_fingerprints_are_dealt_to_parts(spark):
    rows = [(k, "the same text again and again") for k in range(300)] + [(1000 + k, f"text number {k} of {k} other ones {k * k}") for k in range(50)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 350 and {got[k] for k in range(300)} == {0}
    clash = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y"), (None, "other words here", "z")], "doc_id long, text string, __fp string")
    assert sorted(r["__fp"] for r in simhash.representatives(clash).collect()) == ["x", "z"]


# Decontamination.


def plain_tiles(a, b, k):
    k, used_a, used_b, out = max(1, min(k, len(b))), set(), set(), 0
    while True:
        best, found = k - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best:
                    found.append((i, j))
        if best < k:
            return out
        for i, j in found:
            if not any(i + x in used_a or j + x in used_b for x in range(best)):
                used_a.update(range(i, i + best))
                used_b.update(range(j, j + best))
                out += best


def test_tiles_against_plain_tiling():
    number = {w: i + 1 for i, w in enumerate("abcde")}
    for seed in range(300):
        r = random.Random(seed)
        a, b = r.choices("aabbcde", k=r.randint(1, 40)), r.choices("abcd", k=r.randint(1, 12))
        tiles = decontaminate.tile(np.array([number[w] for w in a]), np.array([number[w] for w in b]), 3)
        assert sum(n for n, _, _ in tiles) == plain_tiles(a, b, 3)


def test_reordered_passages_and_both_ways(spark, odd, empty, monkeypatch):
    item = "one two three four five six seven eight nine ten eleven twelve"
    w = item.split()
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, " ".join([*w[6:], "gap", *w[:6]]).upper()), (3, " ".join(w[:6])), (4, "nothing of it"), (5, None), (6, "short one!"), (7, item), (7, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "Short one."), (12, ""), (13, None), (10, item)], "item_id long, text string")

    def found():
        return sorted((r["doc_id"], r["item_id"], r["tiles"], r["matched"]) for r in decontaminate.overlaps(docs, bench).collect())

    here = found()
    assert set(here) == {(1, 10, 1, 12), (2, 10, 2, 12), (3, 10, 1, 6), (6, 11, 1, 2), (7, 10, 1, 12)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [3, 4, 5]
    assert decontaminate.clean(odd, bench).count() == len(ODD) and decontaminate.clean(empty, bench).count() == 0
    assert decontaminate.clean(docs, bench.where("false")).count() == 8
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", 0)
    assert found() == here
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect()) == [3, 4, 5]


def test_tiles_keep_the_order_of_plain_tiling_and_repetitive_texts_are_quick():
    a, b = np.array([1, 2, 3, 9, 1, 2, 3, 4, 9, 1, 2, 3, 4]), np.array([1, 2, 3, 4, 8, 1, 2, 3])
    assert decontaminate.tile(a, b, 3) == [(4, 4, 0), (3, 0, 5)]
    began = time.time()
    assert decontaminate.tile(np.ones(20_000, dtype=np.int64), np.ones(200, dtype=np.int64), 5) == [(200, 0, 0)]
    r = random.Random(1)
    decontaminate.tile(np.array(r.choices([1, 2], k=20_000)), np.array(r.choices([1, 2], k=2_000)), 5)
    assert decontaminate.Index([(0, "a " * 200)], 5).matches("a " * 20_000) == [(0, 1, 200, 200, 1.0)]
    assert time.time() - began < 3


@pytest.mark.parametrize("chars", [decontaminate.BROADCAST_CHARS, 0])
def test_ids_of_any_type_and_null_ids(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", chars)
    item = "one two three four five six seven"
    docs = spark.createDataFrame([("a", item, 1), (None, item, 2), (None, item, 2), ("b", "clean", 3)], "doc_id string, text string, digest int")
    bench = spark.createDataFrame([("x", item), (None, item), (None, item), (None, "short")], "item_id string, text string")
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["coverage"]) for r in decontaminate.overlaps(docs, bench).collect())
    assert got == sorted((d, i, 1.0) for d in ("a", "None", "None") for i in ("x", "None", "None"))
    assert [tuple(r) for r in decontaminate.clean(docs, bench).collect()] == [("b", "clean", 3)]
    assert decontaminate.clean(docs, bench.where("item_id IS NULL")).count() == 1


@pytest.mark.parametrize("chars", [decontaminate.BROADCAST_CHARS, 0])
def test_clean_goes_by_row_not_by_id(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", chars)
    item = "one two three four five six seven"
    docs = spark.createDataFrame([(None, item), (None, "clean"), (None, None), (1, item), (1, "clean too"), (1, "clean too"), (2, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item)], "item_id long, text string")
    assert sorted(str(r["text"]) for r in decontaminate.clean(docs, bench).collect()) == ["None", "clean", "clean too", "clean too"]


# Quality and language.


def test_quality_learns_and_defines_odd_cases(spark, odd, empty):
    r = random.Random(0)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = [(i, " ".join(r.choices(words, k=80)) if i % 2 else " | ".join(w.upper() for w in r.choices(words, k=80)), i % 2) for i in range(300)]
    model = quality.fit_texts([(t, y) for _, t, y in rows[:200]])
    df = spark.createDataFrame([(i, t) for i, t, _ in rows[200:]], "doc_id long, text string")
    got = {x["doc_id"]: x["predicted"] for x in quality.score(df, model).collect()}
    assert np.mean([got[i] == y for i, _, y in rows[200:]]) > 0.95
    scores = quality.score(odd, model).collect()
    assert len(scores) == len(ODD) and all(0 <= x["score"] <= 1 for x in scores)
    labels = spark.createDataFrame([(1, None), (2, 5)], "doc_id long, quality int")
    assert {x["score"] for x in quality.score(odd, quality.fit(odd, labels)).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def test_languages_and_rejection(spark, odd, empty):
    r = random.Random(0)
    sound = {"aa": "bakalama", "bb": "stroxtreg"}
    rows = [(i, " ".join("".join(r.choices(sound[lang], k=5)) for _ in range(20)), lang) for i in range(400) for lang in sound]
    model = langid.fit_texts([(t, lang) for _, t, lang in rows[:600]])
    df = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(rows[600:])], "doc_id long, text string")
    got = {x["doc_id"]: x["lang_pred"] for x in langid.predict(df, model).collect()}
    assert np.mean([got[i] == lang for i, (_, _, lang) in enumerate(rows[600:])]) > 0.99
    own = sorted((str(x["doc_id"]), x["lang_pred"] == "und", x["rejected"] or x["lang_pred"] != "und") for x in langid.predict(odd, model).collect())
    assert [(i, u) for i, u, _ in own] == sorted((str(i), not any(c.isalpha() for c in t or "")) for i, t in ODD)
    assert langid.accepted(odd, model).columns == odd.columns
    assert {x["lang_pred"] for x in langid.predict(odd, langid.fit_texts([])).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_language_blocks_do_not_change_logits(monkeypatch):
    model = langid.fit_texts([("abc def ghi", "x"), ("uvw xyz qrs", "y")] * 20)
    texts = ["", "abc", "def uvw " * 300, "1 2 3", "xyz"]
    whole, n = langid.logits(texts, model)
    monkeypatch.setattr(langid, "BLOCK_CHARS", 50)
    parts, m = langid.logits(texts, model)
    assert np.allclose(whole, parts, atol=1e-5) and (n == m).all()


# HTML.


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header class="site"><a href=/>Home of the site</a></header>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><div class="ad">Buy this very good thing now</div><div id="main-text"><h1>Title &amp; more</h1><p>First <b>bold</b> words of
 the&nbsp;text.<p>Second block, caf&eacute; &lt;tag&gt; and more words here.<!-- not this --><div class="promo">Sponsored words in the middle</div><ul><li>Point one of them<li>Point two of them</ul></div>
<div id="comments"><p>What a great post this is, I liked it a lot</p></div><form><p>Name please</p></form><footer><p>Copyright words at the end</p></footer></body></html>"""
    assert html.main_text(page, html.weights([])) == "Title & more\nFirst bold words of the text.\nSecond block, café <tag> and more words here.\nPoint one of them\nPoint two of them"
    for odd in ("", "<", "<p", "</p>", "<div><div>", "<script>x", "&#xZZ; &amp", "<!--"):
        assert isinstance(html.main_text(odd, html.weights([])), str)


@pytest.mark.parametrize(
    "element",
    ['article class="overflow-hidden"', 'div style="overflow:hidden"', 'div title="The hidden cost"', "div data-x=hidden", 'div class="content with-sidebar"', 'section id="search-algorithms"', 'div title="class=ad" data-role="search"', "div hidden=false"],
)
def test_words_within_attributes_hide_nothing(element):
    page = f"""<body><nav><a href="/">Menu</a></nav><{element}><h2 id="related-work">Related work</h2><p>Many words of the text <a href="/hidden-valley">with a link</a> and more of them</p></{element.split()[0]}></body>"""
    assert html.main_text(page, html.weights([])) == "Related work\nMany words of the text with a link and more of them"


@pytest.mark.parametrize("element", ["div hidden", 'div hidden="hidden"', "div style='color:red; display : none'", "div style=display:none", 'div class="wide sidebar"', 'div id="cookieBanner"', 'div class="social-share"', "div role=search", 'h2 class="ad"', 'section id="comments"'])
def test_what_is_hidden_or_named_stays_out(element):
    page = f"<article><p>Many words of the text</p><{element}><p>not this</p></{element.split()[0]}><p>and some more of them</p></article>"
    assert html.main_text(page, html.weights([])) == "Many words of the text\nand some more of them"


def test_pages_keep_their_rows(spark):
    pages = spark.createDataFrame([(1, "<article><p>words of it</p></article>"), (1, "<article><p>words of it</p></article>"), (2, None), (3, "")], "page_id long, html string")
    got = sorted(tuple(r) for r in html.extract(pages, html.fit(pages)).collect())
    assert got == [(1, "words of it", 11), (1, "words of it", 11), (2, "", 0), (3, "", 0)]
    assert html.extract(pages.where("false"), html.fit(pages.where("false"))).count() == 0


# SentencePiece.

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def test_ids_are_the_library_s(spark, odd, empty):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.load(MODEL)
    r = random.Random(0)
    texts = ["".join(r.choices("abc the ing é\n▁19中.,\"<²½", k=r.randint(0, 200))) for _ in range(150)] + ["the" * 200, "x" * 3000, " " * 40, "a" + " " * 33 + "b", "<s> <0x41>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + k, t) for k, (_, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    coded = pieces.encode(df, model)
    got = {x["doc_id"]: x["ids"] for x in coded.collect()}
    assert got == {i: sp.encode(t or "") for i, t in rows}
    back = {x["doc_id"]: x["text"] for x in pieces.decode(coded, model).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in rows}
    assert pieces.encode(odd, model).count() == len(ODD) and pieces.encode(empty, model).count() == 0


def unigram_model(folder, **changes):
    """A small unigram model's file, made by hand."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m, r = pb.ModelProto(), random.Random(3)
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3), *((f"<0x{b:02X}>", 6) for b in range(256))):
        m.pieces.add(piece=piece, score=0.0, type=kind)
    own = sorted({"▁", *"abcde", *("".join(r.choices("▁", k=r.random() < 0.3)) + "".join(r.choices("abcde", k=r.randint(1, 5))) for _ in range(150))})
    for piece in own:
        m.pieces.add(piece=piece, score=-r.uniform(2, 9), type=1)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, True
    m.normalizer_spec.name, m.normalizer_spec.remove_extra_whitespaces = "identity", False
    for name, value in changes.items():
        setattr(m.normalizer_spec, name, value)
    path = folder / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def test_unigram_ids_are_the_library_s(spark, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = unigram_model(tmp_path)
    sp, model, r = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path), random.Random(4)
    texts = ["".join(r.choices("aabbccdde  é中", k=r.randint(0, 90))) for _ in range(120)] + ["abcde" * 40, "é" * 70, ""]
    assert [pieces.best_path(u, model) for u in ("▁abcab", "éab")] == [sp.encode("abcab"), sp.encode("éab")[1:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    coded = pieces.encode(df, model)
    assert {x["doc_id"]: x["ids"] for x in coded.collect()} == {i: sp.encode(t) for i, t in enumerate(texts)}
    assert {x["doc_id"]: x["text"] for x in pieces.decode(coded, model).collect()} == dict(enumerate(texts))


@pytest.mark.parametrize("changes", [{"remove_extra_whitespaces": True}, {"add_dummy_prefix": False}, {"precompiled_charsmap": b"x"}])
def test_models_with_other_rules_are_refused(tmp_path, changes):
    with pytest.raises(ValueError):
        pieces.load(unigram_model(tmp_path, **changes))


def test_equal_blocks_and_heap_merges(spark, monkeypatch):
    model = pieces.load(MODEL)
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 10)
    df = spark.createDataFrame([(1, "some words here"), (1, "some words here")], "doc_id long, text string").repartition(2)
    both = [x["ids"] for x in pieces.encode(df.union(df), model).collect()]
    assert len(both) == 4 and len({tuple(x) for x in both}) == 1


def test_equal_blocks_are_groups_of_their_own(spark):
    model = pieces.load(MODEL)

    def names(batches):
        with mock.patch.object(pieces, "BLOCK_CHARS", 10):
            for block, ids, *_ in pieces._blocks(batches, model):
                yield pa.RecordBatch.from_pydict({"block": [block], "n": [len(ids)]}, pa.schema([("block", pa.int64()), ("n", pa.int64())]))

    df = spark.createDataFrame(spark.sparkContext.parallelize([(1, "some words here")] * 12, 3), "doc_id long, text string")
    first, again = ([tuple(r) for r in df.mapInArrow(names, "block long, n long").collect()] for _ in range(2))
    assert first == again and len({b for b, _ in first}) == 12 and {n for _, n in first} == {1}


@pytest.mark.parametrize("row_chars", [1, 1 << 30])
def test_ids_by_one_level_of_dealing_and_by_two(spark, monkeypatch, row_chars):
    sentencepiece = pytest.importorskip("sentencepiece")
    r, sp, model = random.Random(12), sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.load(MODEL)
    words = ["".join(r.choices("abcdeéß中 ", k=r.randint(1, 9))) for _ in range(200)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 60))) for _ in range(90)] + ["", "x" * 200, "same text", "same text"]
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 700)
    monkeypatch.setattr(pieces, "GROUP_CHARS", 1_000)
    monkeypatch.setattr(pieces, "ROW_CHARS", row_chars)
    deal = pieces.dealing(sum(map(len, texts)))
    assert (deal.bunches > 1) == (row_chars > 1) and deal.groups > 8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["ids"] for x in pieces.encode(df, model).collect()}
    assert got == {i: sp.encode(t) for i, t in enumerate(texts)}


def test_rows_stay_long_at_any_size():
    """Characters that a row stands for, simulated: 21,000 tokens and more at a hundred terabytes of text."""
    for tera in (0.001, 0.03, 1, 10, 100):
        chars = int(tera * 1e12)
        deal = pieces.dealing(chars)
        assert deal.row_chars(chars) > 20_000 if deal.bunches else deal.row_chars(chars) >= pieces.ROW_CHARS
        # No task holds more than about a block at a bunch's range, nor a bunch more than a few blocks' rows a group.
        assert not deal.bunches or chars / deal.bunches / deal.ranges < 3 * deal.block_chars
    assert not pieces.dealing(int(3e10)).bunches and pieces.dealing(int(1e14)).bunches
