"""The numpy parts against plain versions, without Spark."""

import itertools
import random
import re
import zlib
from re import _parser

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterloom.llm import exact_dedup, html_text, jpeg, language, license_rules, masked_lm, media, mixing, near_dedup, packing, toxicity

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=2000), min_size=1, max_size=4))
def test_jpeg_round_trip(parts):
    payloads = [p + b" " * (-len(p) % jpeg.ROW) for p in parts]
    streams = jpeg.write(payloads)
    assert [jpeg.read(s) for s in streams] == payloads
    assert jpeg.write(payloads[:1])[0] == streams[0]


def test_jpeg_longer_than_an_image():
    data = np.random.default_rng(0).integers(0, 256, jpeg.ROW * (jpeg.MOST_ROWS + 3), dtype=np.uint8).tobytes()
    stream = jpeg.write([data])[0]
    assert len(jpeg.parse(stream)) == 2 and jpeg.read(stream) == data


def test_jpeg_with_other_coefficients_and_no_restarts():
    """A hand-made 16 x 8 grey image: DC +2 and +1 (differences 2, -1), one AC each."""
    dc = bytes([0, 3] + [0] * 14) + bytes([0, 1, 2])  # codes 00, 01, 10
    ac = bytes([0, 2] + [0] * 14) + bytes([0x00, 0x31])  # 00: end; 01: skip 3, size 1
    bits = "10" + "10" + "01" + "1" + "00" + "01" + "0" + "01" + "0" + "00"
    bits += "1" * (-len(bits) % 8)
    scan = int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00")
    part = jpeg._segment
    data = b"\xff\xd8" + part(0xDB, b"\x00" + bytes([16] * 64)) + part(0xC0, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0])) + part(0xC4, b"\x00" + dc) + part(0xC4, b"\x10" + ac) + part(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan + b"\xff\xd9"
    (image,) = jpeg.thumbnails(jpeg.parse(data))
    assert image.tolist() == [[128 + 4, 128 + 2]]


def test_jpeg_refuses_others():
    with pytest.raises(ValueError):
        jpeg.write([b"abc"])
    with pytest.raises(ValueError):
        jpeg.parse(b"not a jpeg")


def test_payload():
    assert media.payload_of(None) == media.payload_of("") == b" " * 192
    assert len(media.payload_of("é" * 96)) == 192 and len(media.payload_of("é" * 97)) == 384


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60))
def test_best_fit_decreasing_is_the_plain_one(lengths):
    which, offset = packing.best_fit_decreasing(np.array(lengths, int), 60)
    rooms, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(r, b) for b, r in enumerate(rooms) if r >= lengths[i]]
        if fits:
            b = min(fits)[1]
        else:
            b = len(rooms)
            rooms.append(60)
        want[i] = (b, 60 - rooms[b])
        rooms[b] -= lengths[i]
    # the same rooms are filled, whichever of equal bins is taken
    assert sorted(60 - np.bincount(which, lengths).astype(int) if lengths else []) == sorted(rooms)
    by = {}
    for i, n in enumerate(lengths):
        by.setdefault(int(which[i]), []).append((int(offset[i]), n))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 60


def test_lengths_out_of_range():
    for n in (0, 61):
        with pytest.raises(ValueError):
            packing.best_fit_decreasing(np.array([n]), 60)


def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    texts = ["", " ", "It's a TEST's, don't! x2y '' ...", "Élan ÜBER ß ª 3² ½", "a<|endoftext|>b", "x\x1fy\x85z\xa0q r", "ΣΑΣ İK ﬁ", "é ́x", "日本語 text", "a\x0bb\x0cc", "".join(map(chr, range(1, 256))), "'sol l'rex 'LL've'd''t x'm. 'é 'l", "'", "'v", "'r"]
    small = packing.Encoder(VOCABULARY, most=7)
    for encoder in (packing.Encoder(VOCABULARY), small):
        for _ in range(2):
            got = encoder.encode(texts)
            assert [g.tolist() for g in got] == [[*plain.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def test_chunks_join_to_the_text_and_shift_with_it():
    rng = random.Random(2)
    data = bytes(rng.randrange(97, 123) for _ in range(60_000))
    assert b"".join(exact_dedup.chunks(data)) == data
    a, b = set(exact_dedup.chunks(data)), set(exact_dedup.chunks(b"prefix" + data))
    assert len(a & b) >= 0.9 * len(a)
    assert all(len(c) <= exact_dedup.MOST for c in a)
    assert exact_dedup.chunks(b"") == [] and exact_dedup.chunks(b"x") == [b"x"]


def test_fill():
    assert mixing.fill([100, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.fill([0, 10], [5, 2], 1.5, 2) == [0.0, 15.0]
    assert mixing.fill([], [], 1.5, 2) == []
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randrange(0, 1000) for _ in range(rng.randrange(1, 9))]
        got = mixing.fill(sizes, [5, 2, 1] * 3, 1.5, 2)
        assert sum(got) == pytest.approx(1.5 * sum(sizes)) and all(t <= 2 * n + 1e-6 for t, n in zip(got, sizes))


def plain_shingles(text, k):
    words = text.encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) > k else {tuple(words)} if words else set()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab C\n ", max_size=40), st.text(alphabet="ab C\n", max_size=40), st.integers(1, 4))
def test_shingles_and_links(a, b, k):
    sa, sb = plain_shingles(a, k), plain_shingles(b, k)
    ha, hb = near_dedup.shingles(a, k), near_dedup.shingles(b, k)
    assert (len(ha), len(hb)) == (len(sa), len(sb))
    assert near_dedup.linked(ha, hb) == (bool(sa & sb) and 100 * len(sa & sb) >= 80 * len(sa | sb))


def test_chunks_settle_as_pairs_do():
    """Components and visits against all pairs; families of near copies, some of
    which only their neighbours link."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 60, 60, dtype=np.uint64)
        for _ in range(rng.integers(1, 9)):
            own = base.copy()
            own[: rng.integers(0, 12)] += np.uint64(rng.integers(1, 1000))
            sets.append(np.unique(own[: rng.integers(50, 61)]))
    links = np.array([[near_dedup.linked(a, b) for b in sets] for a in sets])
    at = np.arange(len(sets))
    for _ in sets:
        at = np.array([at[links[i] | (np.arange(len(sets)) == i)].min() for i in range(len(sets))])
    chunk = near_dedup.Chunk(sets)
    assert chunk.components().tolist() == at.tolist() and len(set(at.tolist())) < len(sets)
    for i, s in enumerate(sets):
        assert chunk.visit(s).tolist() == np.flatnonzero(links[i]).tolist()
    assert chunk.visit(np.array([5], np.uint64)).tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé \t\n\x0b\x1c\u2028"), max_size=12), max_size=8))
def test_words_side_by_side(texts):
    from rosterloom.llm import words

    plain = [[w for w in re.split(rb"[\x20\x09-\x0D]+", t.encode()) if w] for t in texts]
    got, first = words.words_of([t.encode() for t in texts])
    assert np.diff(first).tolist() == [len(p) for p in plain]
    # equal words have equal hashes, and only those
    assert len({(w, h) for w, h in zip((w for p in plain for w in p), got.tolist())}) == len({w for p in plain for w in p}) == len(set(got.tolist()))
    low = words.words_of([t.encode().lower() for t in texts])[0]
    assert words.words_of([t.encode() for t in texts], words.CASELESS)[0].tolist() == low.tolist()


def test_long_words_and_tables():
    from rosterloom.llm import words

    # places that are 1024 apart count differently
    long = [b"x" * 5000 + t + b"x" * 1023 for t in (b"ab", b"ba", b"a" + b"x" * 1023 + b"b", b"b" + b"x" * 1023 + b"a")]
    got, _ = words.words_of(long)
    assert len(set(got.tolist())) == 4 and got.tolist() == [words.words_of([t])[0][0] for t in long]
    rng = np.random.default_rng(3)
    keys = rng.permutation(np.arange(1, 200_001, dtype=np.uint64))
    table = words.Table(4)
    for part in np.split(keys[:150_000], 10):
        assert (table.get(part) < 0).all()
        table.add(part, (part * np.uint64(2)).astype(np.int32))
    assert table.get(keys[:150_000]).tolist() == (keys[:150_000] * np.uint64(2)).tolist() and (table.get(keys[150_000:]) < 0).all()


def test_stores_of_other_operators_go():
    from rosterloom.llm import common

    first = common.kept("one", dict)
    first["x"] = 1
    assert common.kept("one", dict) is first
    common.kept("two", list)
    assert common.kept("three", set, beside=("two",)) == set() and common.kept("two", list, beside=("three",)) == []
    assert common.kept("one", dict) == {}


def test_min_and_max_agree_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a, b = np.unique(values[:250]), np.unique(values[50:])
    x, y = near_dedup.signature(a, 1000), near_dedup.signature(b, 1000)
    assert abs((x == y).mean() - 200 / 300) < 0.04
    assert len(set(near_dedup.band_keys(x[:512], 64).tolist())) == 64


PAGE = '<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class="ad">Buy</div><article><h1>A &amp; B</h1><p>one <b>two</b><br>three\n four<p>five</p><ul><li>x<li>y</ul><div class="comments"><p>reader</p></div><form>f</form><!-- c --><script>var t="</p>";</script></article><footer>&copy; f</footer></body></html>'


def test_main_text():
    assert html_text.extract(PAGE) == "A & B\n\none two three four\n\nfive\n\nx\n\ny"
    assert html_text.extract(PAGE, "/html/body/none") == html_text.extract(PAGE)
    assert html_text.extract("") == "" and html_text.extract("<p") == "" and html_text.extract("<nav>only</nav>") == ""
    assert html_text.extract(PAGE[: PAGE.index("five") + 2]) == "A & B\n\none two three four\n\nfi"
    assert html_text.containers(PAGE)[0][0] == "/html/body/article"


@pytest.mark.parametrize("raw", ["<script>for(var i=0;i<n;i++){x()}</script>", "<SCRIPT>if(a<b&&c>'\"d)</Script >", "<style>a<b{}</style>", "<script>'</scripts>'<c</script\n>", "<textarea><p x=\"</textarea>", "<title>a<b</title>"])
def test_raw_elements_end_at_their_own_tag(raw):
    assert html_text.extract(f"<html><head>{raw}</head><body><article><p>one two</p>{raw}<p>three</p></article></body></html>") == "one two\n\nthree"


@pytest.mark.parametrize("page, want", [
    ('<div class="site-content has-sidebar no-comments"><article><p>All of it stays.</p></article></div>', "All of it stays."),
    ("<p>text</p>", "text"), ("bare text", "bare text"), ("a &lt;b&gt; &amp;c", "a <b> &c"),
    ("<body><p>x &am<b>p;</b>lt; y</p></body>", "x &amp;lt; y"),
    ('<div id="search-results-explained"><p>How results of a search are found.</p></div>', "How results of a search are found."),
    ('<article><div class="post-header"><h1>Title</h1></div><p>Body of the post.</p><div class="post-comments"><p>Nice!</p></div></article>', "Title\n\nBody of the post."),
    ("<form id=f1><div class=content><p>" + "the whole page stands in a form " * 9 + "</p></div><input></form>", ("the whole page stands in a form " * 9).strip()),
    ("<nav><a href=x>Home</a></nav><article><p>One two three.</p></article><div class='comments'><p>" + "a long reader comment " * 3 + "</p></div>", "One two three."),
    ("<article><p>Main.</p><aside>Aside.</aside><div class='cookie-notice'>We use cookies.</div><div class='ad-slot'>Buy!</div></article>", "Main."),
])
def test_what_belongs_to_the_main_text(page, want):
    assert html_text.extract(page) == want


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="<>/pdiv \"'=&;!-ab", max_size=60))
def test_any_page_is_read(page):
    assert isinstance(html_text.extract(page), str)


def test_language_models():
    made = language.learn(["the cat sat on the mat with the hat"] * 12 + ["le chat est sur la table avec les amis"] * 12, ["en"] * 12 + ["fr"] * 12)
    lang, score, rejected = made.predict(["the hat", "la table", "", "123 !", None or ""])
    assert lang == ["en", "fr", "und", "und", "und"]
    assert all(0 <= s <= 1 for s in score) and score[2] == 0
    assert made.predict(["zzzz qqqq xxxx jjjj zzzz qqqq"])[2][0]
    assert language.learn([], []).predict(["a"])[0] == ["und"]


def test_kneser_ney_probabilities_sum_to_one():
    model = language.CharModel(["abracadabra banana abba", "cabana"])
    letters = sorted({c for c in "abrcdn"}) + [" "]
    text = "aban"
    total = 0.0
    for c in letters:
        chars, _ = language.encode([text + c])
        chars = chars if c != " " else np.append(chars[: len(text) + 1], 0).astype(np.uint32)
        grams = language.hashes(chars)
        at = len(text) + 1
        some, ctx = [g[at : at + 1] for g in grams], [np.zeros(1, np.uint64), *[g[at - 1 : at] for g in grams[:-1]]]
        total += float(np.exp(model.log_prob(some, ctx)[0]))
    assert 0.9 < total <= 1.01


def test_toxicity_shares_n_grams_with_misspellings():
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 7))) for _ in range(300)]
    clean = [" ".join(rng.choices(words, k=60)) for _ in range(150)]
    toxic = [" ".join([*rng.choices(words, k=50), *rng.choices(["idiotic", "idiot", "worthless"], k=5)]) for _ in range(60)]
    model = toxicity.train(clean + toxic, [0] * 150 + [1] * 60)
    fresh = " ".join(rng.choices(words, k=50))
    score = model.score([fresh, fresh + " idiots idiott worthles idi0tic idiotik", ""])
    assert score[1] > 0.5 > score[0] and 0 <= score[2] <= 1
    assert toxicity.train([], []).score(["a", ""]).tolist() == pytest.approx([0.01, 0.01])
    assert (toxicity.train(["a", "b"], [0, 0]).score(["a"]) < 0.5).all()


def test_toxicity_reads_long_runs_whole():
    model = toxicity.train(["quiet garden path"] * 20 + ["idiot worthless path"] * 20, [0] * 20 + [1] * 20)
    a, b = model.score(["x" * 500, "x" * 500 + "idiotworthless" * 3])
    assert b > a
    run = "".join(chr(0x4E00 + i) for i in range(1000))
    pieces = toxicity.words_of(run)
    assert max(map(len, pieces)) <= toxicity.LONGEST and all(any(run[i : i + 6] in p for p in pieces) for i in range(995))
    assert toxicity.words_of("a" * 64 + " b") == ["a" * 64, "b"]


def test_masked_network_learns():
    words = masked_lm.Vocabulary(masked_lm.hashes(["a b c d"])[0], np.full(4, 600), [1, 1])
    texts = ["a b c d " * 20] * 30
    around, target, owner = masked_lm.windows(words.encode(texts), words.size - 1)
    assert len(target) == 80 * 30 and owner[-1] == 29
    net = masked_lm.Network(words.size)
    before = net.log_probs(around, target).mean()
    sums = [np.full_like(p, 1e-4) for p in net.parameters()]
    for _ in range(40):
        net.step(around, target, sums, 0.05)
    assert net.log_probs(around, target).mean() > max(before, -0.3)
    copy = masked_lm.Network(words.size, seed=9).load(net.flat())
    assert np.allclose(copy.log_probs(around, target), net.log_probs(around, target))


def test_windows_do_not_cross_texts():
    around, target, owner = masked_lm.windows([[1, 2], [], [3]], 9)
    assert target.tolist() == [1, 2, 3] and owner.tolist() == [0, 0, 2]
    assert around[2].tolist() == [9] * 6 and around[0].tolist() == [9, 9, 9, 2, 9, 9]


def test_every_place_is_a_target_once():
    ids = [[1], [], [2, 3], [4, 5, 6, 7, 8], [9]]
    found = [(o, t) for turn in range(masked_lm.ROUNDS) for _, target, owner in [masked_lm.windows(ids, 0, turn, masked_lm.ROUNDS)] for t, o in zip(target.tolist(), owner.tolist())]
    assert sorted(found) == [(i, t) for i, x in enumerate(ids) for t in x]


def forms(parsed):
    """Strings that a parsed pattern matches: all branches and optional parts, the ends of ranges."""
    each = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            each.append([chr(arg)])
        elif name == "ANY":
            each.append(["q"])
        elif name == "IN":
            each.append([c for o, a in arg for c in ([chr(a)] if str(o) == "LITERAL" else [chr(a[0]), chr(a[1])])])
        elif name == "BRANCH":
            each.append([f for b in arg[1] for f in forms(b)])
        elif name == "SUBPATTERN":
            each.append(forms(arg[-1]))
        else:
            assert name == "MAX_REPEAT"
            each.append([f * n for n in (arg[0], arg[0] + 1) for f in forms(arg[2])])
    return ["".join(x) for x in itertools.product(*each)]


def test_each_form_of_a_licence_rule_holds_its_keyword():
    for rule in license_rules.RULES:
        found = forms(_parser.parse(rule.regex))
        assert all(re.fullmatch(rule.regex, f) for f in found)
        assert [f for f in found if rule.keyword not in f] == [], rule
        # and the rule is tried on each of them, as the words that stand there show
        words = license_rules.keyword_words(rule)
        assert words is None or [f for f in found if not set(words) & set(f.split())] == [], rule
    assert sum(license_rules.keyword_words(r) is None for r in license_rules.RULES) < 5


def test_ids_are_those_of_the_contract():
    assert zlib.crc32(b"17") % 4 == int(zlib.crc32(str(17).encode()) % 4)


@pytest.mark.parametrize("width", [6, 5])
def test_a_step_of_the_network_is_that_of_a_plain_version(width):
    rng = np.random.default_rng(3)
    net = masked_lm.Network(30, width=width, classes=12)
    # beyond what is safe without a shift, every other time
    net.out *= 40 if width == 5 else 1
    around, target = rng.integers(0, 30, (700, 6)), rng.integers(0, 12, 700)
    vector, place, out, bias = (p.astype(float) for p in net.parameters())
    near = vector[around]
    h = np.tanh((near * place).sum(1))
    logit = h @ out.T + bias
    log_p = logit - logit.max(1, keepdims=True)
    log_p -= np.log(np.exp(log_p).sum(1, keepdims=True))
    assert np.allclose(net.log_probs(around, target), log_p[np.arange(700), target], rtol=1e-4, atol=1e-4)
    wrong = (np.exp(log_p) - np.eye(12)[target]) / 700
    down = (wrong @ out) * (1 - h * h)
    grads = [np.zeros_like(vector), (near * down[:, None]).sum(0), wrong.T @ h, wrong.sum(0)]
    np.add.at(grads[0], around, down[:, None] * place)
    sums = [np.full_like(p, 1e-2) for p in net.parameters()]
    net.step(around, target, sums, 0.05)
    for got, was, g in zip(net.parameters(), (vector, place, out, bias), grads):
        assert np.allclose(got, was - 0.05 * g / np.sqrt(1e-2 + g * g + 1e-8), atol=2e-5)


def test_logits_are_written_to_memory_that_is_used_again():
    import tracemalloc

    rng = np.random.default_rng(3)
    net = masked_lm.Network(300)
    around, target = rng.integers(0, 300, (1024, 6)), rng.integers(0, 300, 1024)
    net.log_probs(around, target)
    tracemalloc.start()
    net.log_probs(around, target)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 512 * 300 * 4 / 2
