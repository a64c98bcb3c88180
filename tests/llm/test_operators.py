from __future__ import annotations

import itertools
import re

import numpy as np
import pytest

from deskspark.llm import contamination, language, ngram_join, packing, page_text, pii, quality_model, quality_rules, secret_scan, shard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, blanks, repeated rows, ties, a long text and a NULL id."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return docs_of(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (5, long), (None, "a b c d e f g h"), (6, "a b c d e f g h")])


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(30):
        positions = [0, *sorted(rng.choice(np.arange(1, 60), 14, replace=False).tolist()), 60]
        penalties = [0, *rng.integers(0, 6, 14).tolist(), 0]
        if max(np.diff(positions)) > 16:
            continue

        def cost(ends):
            sizes = np.diff([0, *ends])
            return sum(0 if n & (n - 1) == 0 else 16 - n for n in sizes.tolist()) + sum(penalties[positions.index(e)] for e in ends)

        every = [[*c, 60] for k in range(15) for c in itertools.combinations(positions[1:-1], k)]
        least = min(cost(e) for e in every if max(np.diff([0, *e])) <= 16)
        assert least <= cost(packing.cheapest_cuts(positions, penalties, 16)) <= least + 2 * packing.SLACK


def test_packing_keeps_every_token(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = packing.pack_documents(odd, with_ids=True, partitions=2).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for key, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        if key != 4:
            assert b"".join(bytes(r.ids) for r in own) == ids
    for _, pieces in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def brute_groups(texts):
    sets = {}
    for key, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[key] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
    of = {k: k for k in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((of[a], of[b]))
            of = {k: low if v == high else v for k, v in of.items()}
    return {k: (len(sets[k]), of[k]) for k in texts}


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [f"v{i}" for i in rng.integers(0, 400, 90)]
    texts = {}
    for i in range(80):  # one large group of near copies, some linked, some not
        words = list(base)
        for k in rng.choice(90, int(rng.integers(0, 5)), replace=False):
            words[k] = f"new{rng.integers(0, 1000)}"
        texts[i] = " ".join(words)
    texts |= {100: None, 101: "", 102: "Just Three words", 103: "just three  words", 104: "other words"}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_groups(docs_of(spark, texts.items())).collect()}
    assert got == brute_groups(texts)


def test_prefix_has_enough_matches():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(rng.integers(0, 10**9, 60))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.05], rng.integers(0, 10**9, 3)]))
        both = len(np.intersect1d(a, b))
        frequency = lambda s: s % 7
        (pa_, la), (pb, lb) = ngram_join.chosen_prefix(a, frequency(a)), ngram_join.chosen_prefix(b, frequency(b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_rules_equal_plain_counts(spark, odd):
    more = docs_of(spark, [(7, "x y\nx y\n\nq"), (8, "a b c d e " * 3 + "# * |"), (9, " ".join(["r"] * 12))])
    for r in quality_rules.judge(odd.unionByName(more), odd.select("doc_id")).collect():
        text = {**{x.doc_id: x.text for x in odd.collect()}, **{x.doc_id: x.text for x in more.collect()}}[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        repeated = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)} if len(w) < 100 else None
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        if repeated is not None:
            assert r.n_repeat_words == len(repeated)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_pseudonyms_keep_format_and_links(spark):
    text = "a.b@x.example.com 4111 1111 1111 1111 +1 (017) 555-7713 10.0.0.1. 2021-02-28 29.02.2021 1234567890123"
    first, second = (r.text for r in pii.pseudonymise(docs_of(spark, [(1, text), (2, text)]).select("doc_id", "text"), "k").collect())
    assert first == second
    assert re.fullmatch(r"u[0-9a-f]{16}@pseudonym.invalid \d{4} \d{4} \d{4} \d{4} \+1 \(\d{3}\) \d{3}-\d{4} "
                        r"(\d{1,3}\.){4} \d{4}-\d\d-\d\d 29.02.2021 1234567890123", first)
    assert "4111 1111" not in first and "10.0.0.1" not in first and "017" not in first
    numbers = spark.range(1000).selectExpr("lpad(id, 3, '0') AS d", "3 AS n")
    assert numbers.select(pii.permuted_digits(numbers.d, numbers.n, "t", "k").alias("y")).distinct().count() == 1000


def test_masks_cover_two_substitutions():
    for gone in itertools.combinations(range(contamination.OVERLAP), 2):
        assert any(all(k - at not in {i for i, c in enumerate(m) if c == "1"} for k in gone)
                   for m in contamination.MASKS for at in range(contamination.OVERLAP - len(m) + 1))


def test_leaks_with_substitutions(spark, odd):
    item = [f"item{i}" for i in range(20)]
    changed = list(item)
    changed[3], changed[9] = "other", "words"
    texts = [(10, "x y " + " ".join(item) + " z"), (11, "q " + " ".join(changed)), (12, " ".join(item[:7])), (13, None)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id long, text string")
    found = {r.doc_id for r in contamination.leaks(docs_of(spark, texts).unionByName(odd), bench).collect()}
    assert found == {10, 11}
    assert {r.doc_id for r in contamination.without_leaks(docs_of(spark, texts), bench).collect()} == {12, 13}


def test_page_lines_and_common_subsequence():
    page = ("<html><body class='has-sidebar'><nav>Menu</nav><div class='ad'>Buy</div><article><h1>T&amp;x</h1><p>one <b>two</b>"
            "<p>three<script>no()</script></article><div class='comments'>hi</div><footer>end</footer>")
    assert page_text.Page({"html": page, "host": "h", "path": "/"}).main_text(None, None)[0] == "T&x one two three"
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(0, 5, 12).tolist(), rng.integers(0, 5, 10).tolist()
        best = max(k for k in range(11) for c in itertools.combinations(range(12), k)
                   if (lambda it: all(any(x == y for y in it) for x in [a[i] for i in c]))(iter(b)))
        assert len(page_text.common_positions(a, b)) == best


def test_pages_without_article_lose_shared_lines(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h.example/a/{i}", f"<body><div>Shop</div><p>own {i}</p><div>Terms</div>") for i in range(3)]
        + [(7, None, None), (8, "http://h.example/z", "")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.main_texts(pages, 2).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 7: "", 8: ""}


PAGE = "<html><head><title>t</title></head><body>%s</body></html>"


@pytest.mark.parametrize("body, text", [
    ("<div><p>the body</p></div><section class=comments><article>me too</article></section>", "the body"),
    ("<div class='content with-sidebar'><article>the body</article><div class=sidebar><article>teaser</article></div></div>", "the body"),
    ("<div class='search-page'><article>the body</article></div><nav>menu</nav>", "the body"),
    ("<form action=/x><nav>menu</nav><article><p>the body</p></article><select><option>1</select></form>", "the body"),
    ("<form action=/x><div>the body</div><button>go</button></form>", "the body"),
    ("<article><p>the</p><section class='social-history'><p>body</p></section><div class='social-links'>share</div></article>", "the body"),
    ("<article>the body<form><label>mail</label></form><div class='ad-slot-12'>buy</div></article>", "the body"),
    ("<div class='has-header'><main><p>the body</p></main></div><header>top</header>", "the body"),
    ("<section class=comments><article>me too</article></section>", ""),
    ("<div hidden><article>unseen</article></div><p>the body</p>", "the body"),
])
def test_wrappers_do_not_take_the_text_with_them(body, text):
    page = page_text.Page({"html": PAGE % body, "host": "h", "path": "/", "page_id": 1})
    assert page.main_text(None, None)[0] == text


def test_differencing_confirms_names_that_only_qualify():
    def page(i, note):
        body = f"<article><p>own {i}</p><div class='notice-story'>{note}</div></article>"
        return page_text.Page({"html": PAGE % body, "host": "h", "path": f"/a/{i}", "page_id": i})

    assert page(1, "on all pages").main_text(page(0, "on all pages"), None)[0] == "own 1"
    assert page(1, "only here").main_text(page(0, "only there"), None)[0] == "own 1 only here"


def test_trusted_documents_count_all_and_once(spark):
    """The ratios are those of plain counts, with ids given twice, unknown or NULL."""
    texts = [(i, f"w{i % 7} x{i % 3} y w{i % 5}") for i in range(60)] + [(None, "w1 x1"), (70, None), (71, "")]
    docs = docs_of(spark, texts)
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 60, 2), 4, 4, 999, None]], "doc_id long")
    buckets = {r.words: r.b for r in quality_rules.with_grams(docs.selectExpr("text AS words_", "split(text, ' ') AS words"))
               .selectExpr("words_ AS words", "grams AS b").collect()}
    raw, target = {}, {}
    for i, text in texts:
        for b in buckets[text] if text else ():
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + (i is not None and i < 60 and i % 2 == 0)
    n, m = sum(raw.values()), sum(target.values())
    want = {b: np.log((target[b] + 1) / (m + 65536) / ((raw[b] + 1) / (n + 65536))) for b in raw}
    got = {r.bucket: r.ratio for r in quality_rules.log_ratios(docs, trusted).collect()}
    assert got == pytest.approx(want)


def test_shards_balance_and_keep_groups(spark, odd):
    docs = docs_of(spark, [(i, "t" * int(n)) for i, n in enumerate(np.random.default_rng(4).integers(0, 300, 400))])
    rows = shard.shard_documents(docs).collect()
    loads = {}
    for r in rows:
        loads.setdefault(r.shard, []).append(r)
    sizes = [sum(r["size"] for r in v) for v in loads.values()]
    assert max(sizes) - min(sizes) <= 2 * max(sum(x["size"] for x in rows if x.text_crc32 == r.text_crc32) for r in rows[:50])
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in loads.values())
    assert all(len({r.shard for r in rows if r.text_crc32 == c}) == 1 for c in {r.text_crc32 for r in rows})
    assert shard.shard_documents(odd).count() == odd.count()


def test_isotonic_rises():
    got = quality_model.isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.ones(4))
    assert got.tolist() == [0.1, 0.4, 0.4, 0.9]


def test_language_of_small_texts(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 5)]
    docs = spark.createDataFrame([*rows, (90, None, "en"), (91, "12 3!", "de")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert all(got[i][0] == l for i, _, l in rows) and got[90] == ("und", 0.0) and got[91] == ("und", 0.0)
    x = language.trigrams("Ab", language.letter_classes())
    assert x.tolist() == [(0 * 64 + 1) * 64 + 2, (1 * 64 + 2) * 64 + 0]


def test_secrets_are_redacted(spark, odd):
    key = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"
    texts = [(200 + i, f'word {i} token = "{key[i:] + key[:i]}" more internationalizationword{"abcdefgh"[i % 8]}') for i in range(20)]
    docs = docs_of(spark, texts).unionByName(odd)
    out = {r.doc_id: r.text for r in secret_scan.redact(docs, secret_scan.scan(docs)).collect()}
    assert len(out) == 20 + len({r.doc_id for r in odd.collect()})
    assert all(out[i].count("<secret>") == 1 and "internationalizationword" in out[i] for i in range(200, 220))


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert packing.pack_documents(none).count() == 0
    assert ngram_join.link_groups(none).count() == 0
    assert shard.shard_documents(none).count() == 0
    assert pii.pseudonymise(none, "k").count() == 0
    assert quality_model.score_documents(none, none.selectExpr("doc_id", "1 AS quality")).count() == 0
    assert language.predict(none, language.fit(none)).count() == 0
    assert quality_rules.judge(none, none).count() == 0


def plain_groups(texts, words, percent):
    """component of every (id, text) row, all pairs compared."""
    def shingles(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
        return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    rows = [(i, shingles(t)) for i, t in texts]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        (i, x), (j, y) = rows[a], rows[b]
        if x and y and (100 * len(x & y) >= percent * len(x | y)):
            label[root(a)] = root(b)
    return [min(rows[m][0] for m in range(len(rows)) if root(m) == root(k)) for k in range(len(rows))]


def near_copies(n, seed):
    """Copies of some texts with words replaced: near enough, just not near enough, and far apart."""
    rng = np.random.default_rng(seed)
    base = [[f"w{x}" for x in rng.integers(0, 400, int(rng.integers(3, 160)))] for _ in range(6)]
    texts = []
    for k in range(n):
        words = list(base[int(rng.integers(0, len(base)))])
        for at in rng.integers(0, len(words), int(len(words) * rng.choice([0, 0.01, 0.02, 0.03, 0.2]))):
            words[at] = f"x{rng.integers(0, 1000)}"
        texts.append((k, " ".join(words)))
    return texts


@pytest.mark.parametrize("words, percent, enough", [(4, 85, 2), (5, 80, 2), (4, 85, 10 ** 9)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, words, percent, enough):
    monkeypatch.setattr(ngram_join, "ENOUGH", enough)  # the largest: one round, then all pairs through signatures
    texts = near_copies(150, words) + [(900, None), (901, " \t"), (902, "one two"), (903, "ONE two")]
    texts += [texts[3], (1000, texts[5][1]), (1000, texts[9][1])]  # a repeated row; one id with two texts
    got = ngram_join.link_groups(docs_of(spark, texts), ngram_join.Law(words, percent)).collect()
    groups = plain_groups(texts, words, percent)
    same = {g for (i, _), g in zip(texts, groups) if i == 1000}
    low = min(same)  # the rows of one id are one document, so their groups are one
    want = sorted((i, low if g in same else g) for (i, _), g in zip(texts, groups))
    assert sorted((r.doc_id, r.component_id) for r in got) == want


def test_one_of_each_group_stays(spark):
    texts = near_copies(60, 8)
    more = [(500, "some text of its own that nobody else has at all"), (500, "quite another text under the same number as that one"), (None, "x y"), (None, "x y")]
    docs = docs_of(spark, texts + [texts[0]] + more)
    kept = sorted(ngram_join.one_of_each(docs, ngram_join.Law(5, 80)).collect(), key=repr)
    groups = plain_groups(texts, 5, 80)
    want = {i for (i, _), g in zip(texts, groups) if i == g}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted([*want, 500, 500])
    assert sum(r.doc_id is None for r in kept) == 2 and kept[0].asDict().keys() == docs.collect()[0].asDict().keys()


def test_signatures_never_part_linked_sets():
    rng, known = np.random.default_rng(3), ngram_join.WordHashes()
    for _ in range(300):
        words = [f"w{x}" for x in rng.integers(0, 90, int(rng.integers(5, 200)))]
        other = [w if rng.random() > 0.03 else "z" for w in words]
        a, b = (ngram_join.shingle_set(" ".join(w), known) for w in (words, other))
        apart = sum(int(x ^ y).bit_count() if x ^ y >= 0 else (int(x ^ y) % 2**64).bit_count() for x, y in zip(ngram_join.signature(a), ngram_join.signature(b)))
        assert apart <= len(np.setxor1d(a, b))


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    known = ngram_join.WordHashes()
    words = ["a", "b", "ab", "ba", "aab", "\u00e9" * 40, "x" * 63, "x" * 64, "x" * 65, "x" * 200 + "y", "y" + "x" * 200, "\0", "\0\0", "\u00a0"]
    alone = [known.of(w.encode()).tolist() for w in words]
    assert all(len(h) == 1 for h in alone) and len({h[0] for h in alone}) == len(words)
    blanks = [" ", "\t ", "\n\n", "\x0b", "\x0c", "\r\n", " "]
    for piece in (ngram_join.PIECE, 3):
        monkeypatch.setattr(ngram_join, "PIECE", piece)
        for order in (words, words[::-1]):
            text = " " + "".join(w + blanks[k % len(blanks)] for k, w in enumerate(order))
            assert known.of(text.encode()).tolist() == [alone[words.index(w)][0] for w in order]
    assert [len(known.of(t)) for t in (b"", b" ", b"\n \t")] == [0, 0, 0]
