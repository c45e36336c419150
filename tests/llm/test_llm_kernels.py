"""The operators' kernels against brute force, without Spark."""

import hashlib
import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest
import sentencepiece
import xxhash

from shelfspark.llm import decontaminate, htmlmain, langid, linededup, pii, sentencepieces, simhash, spmodel, tokencount, topk

RAW = open(sentencepieces.DEFAULT_MODEL, "rb").read()
ODD_TEXTS = ["", " ", "  a  b", "▁x ▁", "\x00a\tb\n", "日本語🙂𐍈𐍈x", "<s> hi <0x41> </s>", "a ▁ b", "x" * 3000, "é́​", "a b"]

ODD_TEXTS += ["a ", "end. ", "x  ", "b\n ", " a  "]


def plain_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def test_wu_manber_equals_a_plain_scan():
    rng = random.Random(1)
    words = ["a", "b", "ä", "C1", "日本"]
    for _ in range(60):
        items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4, 5, 9])))) for i in range(4)]
        text = rng.choice([", ", " "]).join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        hit, found = set(), set()
        doc = plain_words(text)
        for item, body in items:
            own = plain_words(body)
            size = min(4, len(own))
            for p in range(len(own) - size + 1 if size else 0):
                for q in range(len(doc) - size + 1):
                    if doc[q:q + size] == own[p:p + size]:
                        hit |= set(range(q, q + size))
                        found.add(item)
        got, by = set(), set()
        own = tuple(decontaminate.words_of(text))
        assert [w.decode() for w in own] == doc
        for table in decontaminate.build(items, 4):
            table.search(own, lambda a, b, i: (got.update(range(a, b)), by.update(i)))
        assert (got, by) == (hit, found)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    pieces = ["a@b.c", "@", ".", "..", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "+", "+1 (551) 555-0826", "4111 1111 1111 1111",
              "4111111111111111", " ", "-", "x", "é", "🙂", "0", "12", "a.b%c+d@e-f.g.", "@x.y", "+4", "(", ")", "255"]
    anchors = pii.automaton()
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        got = [s for s in pii.find(text, anchors) if s[0] in pii.BASE_KINDS]
        assert got == plain_spans(text), text


def test_added_kinds_and_redaction():
    anchors = pii.automaton()
    text = "IBAN: DE89 3704 0044 0532 0130 00, acct 12-345-678, ftp://bob:pw@h.example/x and http://h.example/"
    found = {kind: text[a:b] for kind, a, b in pii.find(text, anchors) if kind not in pii.BASE_KINDS}
    assert found == {"iban": "DE89 3704 0044 0532 0130 00", "account": "12-345-678", "url": "ftp://bob:pw@h.example/x"}
    assert pii.redact("mail a@b.c now", "email:5:10") == "mail [email] now"
    assert pii.redact(None, "") is None


def test_coder_agrees_with_the_original_and_decodes():
    coder = sentencepieces.Coder(RAW, cached=3)
    texts = ODD_TEXTS + [" ".join(t) for t in itertools.permutations(["the", "Übung", "b\nc", "42"])]
    got = coder.encode(texts)
    assert [ids.tolist() for ids, _ in got] == coder.original.encode(texts) and all(same for _, same in got)
    assert [coder.decode(ids.tolist()) for ids, _ in got] == [coder.original.decode(ids.tolist()) for ids, _ in got]
    assert coder.decode([coder.model.byte_ids[0xE2]]) == "�"


def test_model_file_is_read_as_the_library_reads_it():
    model, library = spmodel.parse(RAW), sentencepiece.SentencePieceProcessor(model_proto=RAW)
    assert model.pieces == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert np.allclose(model.scores, [library.get_score(i) for i in range(len(model.pieces))])


def test_token_counts_equal_the_unigram_tokenizer():
    model = spmodel.parse(RAW)
    counter = tokencount.Counter(model, cached=4)
    model.kind = spmodel.UNIGRAM
    tokenizer = sentencepieces.rebuild(model)
    rng = random.Random(3)
    texts = [t for t in ODD_TEXTS if "<" not in t and "\x00" not in t]  # the library also matches control and byte pieces in texts
    texts += ["".join(rng.choice("abc the éü🙂\n▁") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    assert [counter.count(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.count(None) == 0


def test_fingerprints_equal_their_definition():
    rng = random.Random(4)
    for text in [None, "", " \t", "One", "a b c d", "A b  c\nd e"] + [" ".join(rng.choice("abcÄ") for _ in range(rng.randint(5, 40))) for _ in range(50)]:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == want


def test_every_close_pair_shares_a_part():
    rng = np.random.default_rng(5)
    bits = rng.random((500, 64)) < rng.uniform(0.2, 0.8, 64)
    both = bits.T.astype(float) @ bits
    for tau in (1, 3, 4):
        for n in (500, 10**6, 10**10):
            parts = simhash.plan(n, both * n / 500, tau)
            assert sum(t + 1 for _, t in parts) == tau + 1
            assert len({b for own, _ in parts for b in own}) == sum(len(own) for own, _ in parts)
            for _ in range(300):
                flips = set(rng.choice(64, tau, replace=False).tolist())
                assert any(len(flips & set(own)) <= t for own, t in parts)


def plain_lengths(left, other):
    def common(place, there):
        size = 0
        while place + size in left and left[place + size] == other.get(there + size):
            size += 1
        return size
    return {place: max((common(place, there) for there in other), default=0) for place in left}


def test_blocks_equal_plain_matching():
    rng = random.Random(1)
    for _ in range(1500):
        size, kinds = rng.randrange(0, 14), rng.choice([1, 2, 3, 6])
        left, other = ({i: rng.randrange(kinds) for i in range(size) if rng.random() < 0.85} for _ in range(2))
        lengths = linededup._match_lengths(left, other)
        assert lengths == plain_lengths(left, other)
        blocks = linededup._longest_first({p: x for p, x in left.items() if lengths[p]}, other)
        rest, expected = dict(left), []
        while longest := max(((n, -p) for p, n in plain_lengths(rest, other).items() if n), default=None):
            expected.append([*range(-longest[1], -longest[1] + longest[0])])
            rest = {p: x for p, x in rest.items() if p not in expected[-1]}
        assert [len(b) for b in blocks] == [len(b) for b in expected] and blocks == expected
        for block in linededup.aligned_blocks(left, other):
            assert any(all(other.get(there + i) == left[p] for i, p in enumerate(block)) for there in other)


def test_repeated_lines_take_linear_time():
    rng = random.Random(2)
    two = [[rng.randrange(2) for _ in range(100_000)] for _ in range(2)]
    start = time.time()
    for mine, other in (two, ([7] * 100_000,) * 2, (range(100_000), range(100_000, -1, -1)), ([*range(50_000), *([1, 2] * 25_000)], [*([1, 2] * 25_000), *range(50_000), 1, 2])):
        linededup.aligned_blocks(dict(enumerate(mine)), dict(enumerate(other)))
    assert time.time() - start < 40


def test_alignment():
    assert linededup.align({0: 5, 1: 6, 2: 7}) == {0, 1, 2}
    assert linededup.align({0: 9, 1: 1, 2: 2, 5: 1}) == {0, 1, 2, 5}  # moved and repeated lines as well
    assert linededup.align({i: 100 - i for i in range(100)}) == set(range(100))
    assert linededup._longest_rising([(0, 5), (1, 1), (2, 2), (3, 0), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]


def owner_rows(text, owner):
    return [(linededup._hash(line.strip(" \t\r")), owner, at) for at, line in enumerate(x for x in text.split("\n") if x.strip())]


def test_blocks_go_and_short_lines_stay():
    shared = "one two three four five six seven eight nine ten"
    rows = owner_rows(f"title\n{shared}\nyes", 1)
    assert linededup.without_blocks(f"mine\n\n{shared} \nother\nyes", rows, 10) == ("mine\n\nother\nyes", 1)
    assert linededup.without_blocks(f"{shared}\nyes\nx", rows, 10) == ("x", 2)
    assert linededup.without_blocks("yes\nx", rows, 10) == ("yes\nx", 0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href='/a'>a</a></ul></nav><!-- x <p>no</p> --><div class="ad">buy</div>
<div class='cookie-notice'>cookies</div><article><header><h1>Title &amp; more</h1></header><p><b>One&nbsp;two<br>three<p>Fo<i>u</i>r &#8211; &auml;
<div><div>in</div> tail</div><form><p>mail</p></form><section id="comments"><p>nice</p></section></article>
<aside>side</aside><footer>&copy; me</footer></body></html>"""


def page_text(html):
    found, spans, _ = htmlmain.blocks(html)
    return htmlmain.without([text for text, _ in found], [main for _, main in found], spans, set())


def test_main_text_of_a_page():
    assert page_text(PAGE) == "Title & more\nOne two three\nFour – ä\nin\ntail"
    assert page_text(None) == page_text("") == ""
    assert page_text("<p>a < b</p>x<div cla") == "a < b\nx"
    assert page_text("<article><p>a<p title='x>y'>b</article><p>c") == "a\nb"
    assert page_text("<div class='content-with-sidebar'><p>kept</p><div class='left-sidebar'>x</div></div>") == "kept"
    assert page_text("<p>only <script>if (a<b) x()") == "only"
    assert page_text("<div>&lt;b&gt; " + "w " * 5000 + "</div>") == unescape("&lt;b&gt;") + " w" * 5000


def plain_contents(found, spans):
    """Which blocks each hash leaves, by looking at every block for every hash."""
    pool = [at for at, (_, main) in enumerate(found) if main] or list(range(len(found)))
    left = {}
    for value in {s[0] for s in spans}:
        inside = {at for hash_, low, high in spans if hash_ == value for at in range(low, high)}
        left[value] = tuple(found[at][0] for at in pool if at not in inside)
    return left


def test_contents_outside_of_elements_equal_a_plain_pass():
    rng = random.Random(5)
    texts, seen = {}, 0
    for _ in range(1000):
        html = ""
        for _ in range(rng.randrange(40)):
            html += rng.choice(["<div>", "</div>", "<ul>", "</ul>", "<li>", "<p>", "</p>", "<section class=a>", "</section>", "<article>", "</article>", "<nav>", "</nav>", "a", "b ", "c d"])
        found, spans, outside = htmlmain.blocks(html)
        left = plain_contents(found, spans)
        assert set(outside) == {value for value, rest in left.items() if rest}
        for value, content in outside.items():  # equal hashes for equal texts, different ones for different texts
            assert texts.setdefault(left[value], content) == content
            seen += 1
        gone = {s[0] for s in spans if rng.random() < 0.3}
        inside = {at for value, low, high in spans if value in gone for at in range(low, high)}
        rest = [b for at, b in enumerate(found) if at not in inside]
        assert htmlmain.without([b[0] for b in found], [b[1] for b in found], spans, gone) == "\n".join(b[0] for b in [b for b in rest if b[1]] or rest)
    assert len(set(texts.values())) == len(texts) > 100 and seen > 500


@pytest.mark.parametrize("page", ["<tr><td>cell {0}</td></tr>", "<div>open {0}", "<div>same</div>", "<li>item {0}</b2>", "<div><p>x</section>"])
def test_long_pages_take_linear_time(page):
    began = time.time()
    found, spans, outside = htmlmain.blocks("<table>" + "".join(page.format(i) for i in range(40_000)))
    assert len(found) == 40_000 and time.time() - began < 10


def test_search_block_equals_brute_force():
    rng = np.random.default_rng(6)
    c = np.floor(rng.normal(size=(400, 8)) * 20)
    c[50:120] = c[3]
    pivots = topk.choose_pivots(c[:50], 6)
    far = np.sqrt(((c[:, None] - pivots[None]) ** 2).sum(axis=2))
    rows, ids = np.arange(400), np.arange(400)[::-1].copy()
    got = topk.search_block((rows[:40], ids[:40], c[:40], far[:40], np.full(40, -1e300)), (rows, ids, c, far), 5)
    want = []
    for q in range(40):
        scores = c @ c[q]
        want += [(q, r, int(ids[r]), int(scores[r])) for r in sorted((r for r in range(400) if r != q), key=lambda r: (-scores[r], ids[r]))[:5]]
    assert got == want
    assert len(topk.choose_pivots(np.zeros((4, 3)), 3)) == 1


def test_language_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Ähnlich, wie 3 Katzen -- und  ein Hund!" * 20
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_PIECE", 7)
    # a piece may split a run without letters, which then counts as two spaces
    assert np.abs(langid.counts(text) - whole).sum() < 0.4 * whole.sum()
    rows = np.eye(4)[[0, 0, 1, 1]]
    assert len(langid.cluster(rows, 4)) == 2


def test_digest_of_no_items_is_that_of_empty_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_lists_of_lines_come_in_few_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"k": list(range(100)), "held": [[1, 2]] * 100})
    slices = list(linededup._slices([batch, batch]))
    assert sum(x.num_rows for x in slices) == 200 and max(x.num_rows for x in slices) == linededup.LISTS_AT_ONCE
