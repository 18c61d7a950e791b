"""The numpy parts of the operators against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from pageloom.llm import boosting, crf
from pageloom.llm import html_text as H
from pageloom.llm import language as L
from pageloom.llm import language_model as LM
from pageloom.llm import mixing as MX
from pageloom.llm import ngram_join as NG
from pageloom.llm import text as TX
from pageloom.llm import token_counts as TC
from pageloom.llm import toxicity as TO
from pageloom.llm.html_blocks import blocks


def as_piece(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64)


def chain(odds, first, start, moves):
    """Marginals of a two-state chain by trying all paths."""
    out = []
    for a, z in zip(first[:-1], first[1:]):
        weight = {}
        for path in itertools.product((0, 1), repeat=z - a):
            score = sum(odds[a + k] for k, s in enumerate(path) if s) + (start if path and path[0] else 0)
            weight[path] = np.exp(score + sum(moves[x, y] for x, y in zip(path, path[1:])))
        total = sum(weight.values())
        out += [sum(w for p, w in weight.items() if p[k]) / total for k in range(z - a)]
    return np.array(out)


def test_binary_marginals_and_viterbi():
    dice = np.random.default_rng(4)
    first = np.array([0, 3, 3, 4, 12])
    odds, moves = dice.normal(size=12) * 2, dice.normal(size=(2, 2))
    p, _ = crf.binary_marginals(odds, first, 0.4, moves)
    assert np.allclose(p, chain(odds, first, 0.4, moves))
    both = np.stack([np.zeros(12), odds], axis=1)
    assert np.allclose(crf.marginals(both, first, np.array([0, 0.4]), moves)[0][:, 1], p)
    best = crf.viterbi(both, first, np.array([0, 0.4]), moves)
    for a, z in zip(first[:-1], first[1:]):
        score = lambda path, a=a: sum(odds[a + k] for k, s in enumerate(path) if s) + 0.4 * (path[0] if path else 0) + sum(moves[x, y] for x, y in zip(path, path[1:]))
        assert np.isclose(score(tuple(best[a:z])), max(map(score, itertools.product((0, 1), repeat=z - a))))


def test_long_chains_equal_stepwise_ones():
    dice = np.random.default_rng(5)
    first = np.array([0, 1_000, 5_000])
    odds, moves = dice.normal(size=5_000) * 4, dice.normal(size=(2, 2)) * 2
    p, moved = crf.binary_marginals(odds, first, -1.0, moves)
    q, also = crf.marginals(np.stack([np.zeros(5_000), odds], axis=1), first, np.array([0, -1.0]), moves)
    assert np.allclose(p, q[:, 1]) and np.allclose(moved, also)


def test_trees_are_monotone_where_asked():
    dice = np.random.default_rng(1)
    x = dice.random((800, 3))
    y = (x[:, 0] + 0.4 * np.sin(9 * x[:, 1]) + 0.2 * dice.normal(size=800) > 0.6).astype(float)
    trees = boosting.fit(x, y, np.array([1, 0, -1]))
    assert ((trees.probabilities(x) > 0.5) == (y > 0.5)).mean() > 0.85
    grid = np.repeat(dice.random((40, 1, 3)), 60, axis=1)
    for feature, sign in ((0, 1), (2, -1)):
        lines = grid.copy()
        lines[:, :, feature] = np.linspace(-0.5, 1.5, 60)
        p = trees.margins(lines.reshape(-1, 3)).reshape(40, 60)
        assert (sign * np.diff(p, axis=1) >= -1e-9).all()


def test_words_and_windows_stay_in_their_text():
    data, offsets = as_piece(["a b c d", "", "  ", "d", "a b c"])
    found = TX.words(data, offsets)
    assert found.counts.tolist() == [4, 0, 0, 1, 3]
    hashes = TX.span_hashes(data, found.start, found.end)
    grams, at = TX.window_hashes(hashes, found.first, 3)
    assert at.tolist() == [0, 1, 5] and grams[0] == grams[2] != grams[1]


def test_codewords_are_apart():
    for n in (0, 1, 2, 4, 6, 9, 20):
        code = L.codewords(n)
        assert code.shape[0] == n
        assert all((code[a] != code[b]).any() for a in range(n) for b in range(a))
        assert n < 2 or (abs(code.sum(axis=0)) < n).all()


def test_identifier_on_made_up_languages():
    dice = random.Random(2)
    make = lambda letters: " ".join("".join(dice.choices(letters, k=5)) for _ in range(60))
    kinds = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "éèçàù", "ee": "stuvw"}
    texts, labels = zip(*[(make(v), k) for k, v in kinds.items() for _ in range(20)])
    model = L.fit_identifier(pa.array(texts), list(labels))
    data, offsets = as_piece([make(v) for v in kinds.values()] + [make("abcdefghij")])
    best, score, second = model.decode(model.evidence(data, offsets))
    assert [model.languages[k] for k in best[:5]] == list(kinds)
    assert (score[:5] > 0.9).all() and (second[:5] < 0.1).all()


@pytest.mark.parametrize("sizes", [[], [0], [10], [10, 10, 10], [1, 100, 1000, 50], [5, 0, 7]])
def test_targets_add_up_and_stop(sizes):
    weights = [MX.cycled_weight(k) for k in range(len(sizes))]
    targets = MX.source_targets(sizes, weights, 1.5, 2)
    assert all(t <= 2 * s + 1e-9 for t, s in zip(targets, sizes))
    assert np.isclose(sum(targets), 1.5 * sum(sizes))
    free = [t / w for t, w, s in zip(targets, weights, sizes) if s and t < 2 * s - 1e-9]
    assert not free or np.allclose(free, free[0])


def test_splitting_tree_gives_each_place_once():
    quotas = np.array([0, 7, 100, 1, 33])
    whole = list(MX.split_quotas(quotas, 13, 3, 0, 13))
    again = [x for low in range(0, 13, 4) for x in MX.split_quotas(quotas, 13, 3, low, low + 4)]
    assert [w[0] for w in whole] == list(range(13)) == [a[0] for a in again]
    for source, quota in enumerate(quotas):
        places = [p for _, first, n in whole for p in range(first[source], first[source] + n[source])]
        assert places == list(range(quota))
    assert all((a[1] == w[1]).all() and (a[2] == w[2]).all() for a, w in zip(again, whole))
    assert max(n.sum() for *_, n in whole) - min(n.sum() for *_, n in whole) <= 4


def test_prefixes_of_linked_sets_meet():
    """Any two sets that are linked share a signature, whatever tokens are frequent."""
    dice = np.random.default_rng(8)
    rule = NG.Rule()

    class Some:
        def classes(self, tokens):
            return 1 + ((tokens % np.uint64(7)) < self.many).astype(np.int8) + ((tokens % np.uint64(7)) < self.most)

    for many, most in ((0, 0), (3, 0), (7, 0), (7, 3), (7, 7)):
        frequent = Some()
        frequent.many, frequent.most = many, most
        for n in (9, 10, 15, 16, 31, 40, 130, 500):
            for _ in range(25):
                x = np.unique(dice.integers(0, 1 << 60, n).astype(np.uint64))
                lost = int(dice.integers(0, rule.lacking(len(x)) + 1))
                y = np.delete(x, dice.choice(len(x), lost, replace=False))
                more = dice.integers(0, 1 << 60, int(dice.integers(0, max(1, len(x) // 18)))).astype(np.uint64)
                y = np.unique(np.concatenate([y, more]))
                shared = len(np.intersect1d(x, y))
                if len(x) != len(y) or (x != y).any():
                    if 100 * shared >= 90 * (len(x) + len(y) - shared):
                        assert np.intersect1d(NG.signatures(x, frequent, rule), NG.signatures(y, frequent, rule)).size


def test_prefixes_meet_by_the_rule_of_the_pipeline():
    dice = np.random.default_rng(9)
    rule, met = NG.Rule(5, 80), 0

    class Some:
        def classes(self, tokens):
            return 1 + ((tokens % np.uint64(7)) < self.many).astype(np.int8) + ((tokens % np.uint64(7)) < self.most)

    for many, most in ((0, 0), (3, 0), (7, 0), (7, 3), (7, 7)):
        frequent = Some()
        frequent.many, frequent.most = many, most
        for n in (4, 5, 9, 10, 16, 31, 40, 130, 500):
            for _ in range(25):
                x = np.unique(dice.integers(0, 1 << 60, n).astype(np.uint64))
                y = np.delete(x, dice.choice(len(x), int(dice.integers(0, rule.lacking(len(x)) + 1)), replace=False))
                more = dice.integers(0, 1 << 60, int(dice.integers(0, max(1, len(x) // 8)))).astype(np.uint64)
                y = np.unique(np.concatenate([y, more]))
                shared = len(np.intersect1d(x, y))
                if 5 * shared >= 4 * (len(x) + len(y) - shared) and not np.array_equal(x, y):
                    met += 1
                    assert np.intersect1d(NG.signatures(x, frequent, rule), NG.signatures(y, frequent, rule)).size
    assert met > 300


def test_token_tree_follows_edits():
    tokenizer = TC.Tokenizer(open(TC.VOCABULARY, "rb").read())
    dice = random.Random(3)
    pieces = ["a", "b", " ", "  ", "\n", "'", "'s", "1", "é", "ñ", "!", "\t", "the ", "ing", "　", "😀"]
    for _ in range(150):
        text = "".join(dice.choices(pieces, k=dice.choice((0, 1, 5, 60, 400))))
        tree = TC.TokenTree(tokenizer, text)
        for _ in range(5):
            a = dice.randint(0, len(text))
            z = min(len(text), a + dice.choice((0, 1, 3, 40)))
            new = "".join(dice.choices(pieces, k=dice.choice((0, 1, 2, 8, 300))))
            text = text[:a] + new + text[z:]
            tree.edit(TC.Edit(a, z, new))
            assert tree.text == text and tree.n_tokens == tokenizer.total(text) and tree.n_chars == len(text)


def test_edits_touch_few_tokens():
    tokenizer = TC.Tokenizer(open(TC.VOCABULARY, "rb").read())
    tree = TC.TokenTree(tokenizer, "some words of a long text, " * 5_000)
    tokenizer.encoded = 0
    tree.edit(TC.Edit(60_000, 60_004, "other"))
    assert tokenizer.encoded < 12
    tree.edit(TC.Edit(-5, 10**9, ""))
    assert tree.n_tokens == 0 and tree.text == ""


def test_model_is_normalised():
    dice = np.random.default_rng(2)
    model = LM.LogBilinear.fresh(np.full(LM.OUTPUTS, 1 / LM.OUTPUTS))
    context = np.repeat(dice.integers(0, LM.OUTPUTS + 1, (1, LM.CONTEXT)), LM.OUTPUTS, axis=0)
    assert np.isclose(np.exp(model.log_probabilities(np.arange(LM.OUTPUTS), context)).sum(), 1, atol=1e-5)
    again = LM.LogBilinear.from_flat(model.flat())
    assert all((a == b).all() for a, b in zip(model.parts(), again.parts()))


def test_training_learns_what_follows():
    share = np.full(LM.OUTPUTS, 1 / LM.OUTPUTS)
    codes = np.tile([3, 9, 27, 81], 2_000)
    context = LM.contexts(codes, np.array([0, len(codes)]))
    model = LM.LogBilinear.fresh(share)
    before = model.log_probabilities(codes, context).mean()
    trainer = LM._Trainer(model, share)
    for k in range(0, 8_000, 256):
        trainer.step(codes[k : k + 256], context[k : k + 256])
    assert model.log_probabilities(codes, context).mean() > before + 1


def test_page_blocks():
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=/x>One</a></ul></nav>"
        "<!-- <p>no --><div class=\"ad\">Buy</div><article><h1>Head &amp; tail</h1><p>a\n b<br>c<p title='x > y'>d &lt;e&gt;</article>"
        "<footer>end"
    )
    found = [(b.text, b.tag) for b in blocks(page)]
    assert found == [("One", "li"), ("Buy", "div"), ("Head & tail", "h1"), ("a b c", "p"), ("d <e>", "p"), ("end", "footer")]
    assert [b.text for b in blocks("<p>x <!-- never closed <p>y")] == ["x"]
    assert blocks("") == [] and blocks("<script>only") == [] and [b.text for b in blocks("plain")] == ["plain"]


def test_elements_without_an_end_cut_no_page():
    def texts(page):
        return [b.text for b in blocks(page)]

    for empty in ("<svg/>", "<math/>", "<svg width=1 />", "<!-->", "<!--->", "<select>", "<button>", "<noscript>", "<svg>"):
        assert texts(f"<p>x{empty}</p><p>y</p><p>z</p>") == ["x", "y", "z"], empty
        assert texts(f"<p>x</p>{empty}<p>y</p><svg></svg><!-- --><button></button><p>z</p>") == ["x", "y", "z"], empty
    assert texts("<head><title>x</title><p>Article") == ["Article"]
    assert texts("<head><meta a=b><link c=d>\n<title>x</title>\n<script>s</script>Bare text<p>Article") == ["Bare text", "Article"]
    assert texts("<head><title>x</head><body><p>Article</p><svg><title>t</title></svg>") == ["Article", "t"]
    assert texts("<head><noscript><img src=a></noscript><title>x</title></head><p>Article") == ["Article"]
    assert texts("<p>a <select><option>b<option>c</select> d</p>") == ["a", "b", "c", "d"]
    for tag in ("noscript", "math", "object", "button", "video", "audio"):
        assert texts(f"<article><p>one <{tag}>two</{tag}> three</p></article>") == ["one two three"]
    assert texts("<p>a</p><script>b</script><style>c</style><textarea><p>d</textarea><p>e") == ["a", "e"]
    assert [b.inside for b in blocks("<select><option>a</select><object><p>b</object><p>c")] == [("form",), ("embedded",), ()]
    blocks("<head>" + "<title>" * 20_000)
    blocks("<head>" * 20_000 + "<svg><title>" * 5_000)


def test_article_words_in_fallback_content_stay():
    words = "This is a long sentence of the story, and it says what happened then. " * 3
    for tag in ("noscript", "object", "video"):
        page = f"<html><body><article><h1>Title of it</h1><p>{words}</p><{tag}><p>{words} Last words.</p></{tag}><p>{words}</p></article></body></html>"
        assert "Last words." in " ".join(H.article_blocks([page], H.train())[0]), tag


def test_pages_of_any_shape_are_read_in_time():
    assert blocks("<b>" * 30_000 + "x")[0].text == "x"
    assert len(blocks("<!-- x " * 50_000 + "<p>y")) == 0
    blocks('<a "' * 20_000)
    blocks("<p><b>" * 5_000)


def test_articles_of_held_out_layouts():
    field = H.train()
    right = wrong = missed = 0
    for found, labels in H.labelled_pages(120, seed=77):
        state = field.decode(H.block_features(found), np.array([0, len(found)]))
        right += ((state == 1) & (labels == 1)).sum()
        wrong += ((state == 1) & (labels == 0)).sum()
        missed += ((state == 0) & (labels == 1)).sum()
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_toxic_words_and_beginnings_are_found():
    dice = random.Random(6)
    plain = ["".join(dice.choices("abcdefg", k=dice.choice((2, 4, 6)))) for _ in range(400)]
    texts, toxic = [], []
    for k in range(400):
        body = dice.choices(plain, k=60)
        if k % 4 == 0:
            for _ in range(3):
                body.insert(dice.randrange(60), dice.choice(["ZOT", "zot,", "quxx" + dice.choice(plain)]))
        texts.append(" ".join(body))
        toxic.append(int(k % 4 == 0))
    tagger = TO.fit_tagger(pa.array(texts[:300]), np.array(toxic[:300]))
    data, offsets = as_piece(texts[300:] + ["", "..."])
    found, p = tagger.tag(data, offsets)
    scores = tagger.scores(found, p)
    assert ((scores[:100] >= 0.5) == (np.array(toxic[300:]) == 1)).mean() > 0.97
    assert (scores[100:] < 0.5).all()
    spans = TO._spans(found, p, offsets, 0.5).to_pylist()
    hit = {texts[300 + k].encode()[s["start"] : s["end"]].decode().lower()[:3] for k in range(100) if toxic[300 + k] for s in spans[k]}
    assert {"zot", "qux"} <= hit and spans[100] == spans[101] == []
