"""Long, repetitive and badly closed texts: the same results, in bounded time."""

import random
import time

import numpy as np
import pytest

from claimrisk.llm import decontaminate, maintext, prefixcounts
from claimrisk.llm.hashing import words_of

BODY = ("<h1>How it went</h1><p>The story of this page is told here in a good many words, as it should be, so that "
        "one knows it.</p><p>It goes on in a second paragraph, which has about as many words as the first one has.</p>")
TEXT = ("How it went\nThe story of this page is told here in a good many words, as it should be, so that one knows it."
        "\nIt goes on in a second paragraph, which has about as many words as the first one has.")


@pytest.fixture(scope="module")
def tree():
    return maintext.Tree(*maintext.labelled_table())


@pytest.mark.parametrize("before, after", [
    ("<article class='post type-post tag-social category-search'>", "</article>"),
    ("<article id='share-story'>", "</article>"),
    ("<div class='page has-sidebar'>", "</div>"),
    ("<article><div class='article-header'>", "</div></article>"),
    ("<main><header class=masthead>", "</header></main>"),
    ("<article>", "<textarea>left from a form that nobody sent</textarea><iframe src=x>no frames here</iframe></article>"),
    ("<article>", "</article><div class='responses'><p>I read this and I think that it is all wrong, as I said "
                  "before</p></div>"),
    ("<article>", "<p class='advert'>Buy one of ours, it is the best there is and it lasts a lifetime</p></article>"),
])
def test_names_of_what_holds_the_text_and_of_what_does_not(tree, before, after):
    assert maintext.extract(f"<html><body>{before}{BODY}{after}</body></html>", tree) == TEXT


@pytest.mark.parametrize("page", [
    "<p " * 100_000, '<p a="' * 100_000, "<p a='" * 100_000, "<!-- " * 100_000, "<" * 200_000, "</div>" * 100_000,
    "<div>" * 60_000 + "</ul>" * 60_000, "<div>" * 60_000 + "</div>" * 60_000, "<svg>" * 60_000, "&amp" * 100_000])
def test_pages_that_are_not_closed_take_linear_time(tree, page):
    start = time.time()
    maintext.extract(page, tree)
    assert maintext.extract(f"<article>{BODY}</article>" + page, tree).startswith("How it went")
    assert time.time() - start < 6


def test_tiles_of_repeated_words_are_found_without_a_list_of_seeds():
    seeds = decontaminate.Seeds(["again " * 20_000, "a b c d e f g"])
    start = time.time()
    got = seeds.tiled(words_of("again " * 20_000 + "a b c d e f g")[0])
    assert got == {0: [(0, 0, 20_000)], 1: [(0, 20_000, 7)]}
    assert time.time() - start < 5


def test_tiles_do_not_depend_on_how_they_are_found(monkeypatch):
    r = random.Random(7)
    for _ in range(80):
        letters = r.choice(["ab", "abc", "abcdefgh"])
        item, doc = (" ".join(r.choice(letters) for _ in range(r.randint(1, 90))) for _ in range(2))
        seeds = decontaminate.Seeds([item])
        words = words_of(doc)[0]
        monkeypatch.setattr(decontaminate, "LISTED", 10 ** 9)
        few = seeds.tiled(words)
        monkeypatch.setattr(decontaminate, "LISTED", 0)
        many = seeds.tiled(words)
        assert {i: sorted(t) for i, t in few.items()} == {i: sorted(t) for i, t in many.items()}


def test_seams_tell_what_merging_tells():
    import public_tokenizers
    vocabulary = prefixcounts.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    r = random.Random(3)
    tokens = sorted(vocabulary.tokens)
    short = [t for t in tokens if len(t) < 4]
    for i in range(20_000):
        left, right = (r.choice(short if i % 2 else tokens) for _ in range(2))
        assert vocabulary.apart(left, right) == (vocabulary.merged(left + right) == [left, right])


def test_what_is_remembered_does_not_change_counts(monkeypatch):
    import public_tokenizers
    vocabulary = prefixcounts.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    r = random.Random(5)
    texts = [" ".join("".join(r.choice("etaoin.\n") for _ in range(r.randint(1, 9))) for _ in range(80)) for _ in range(40)]
    whole = prefixcounts.PrefixCounter(vocabulary, public_tokenizers.PATTERN)
    small = prefixcounts.PrefixCounter(vocabulary, public_tokenizers.PATTERN)
    small.pieces.most = small.words.most = small.pairs.most = 30
    for t in texts:
        assert np.array_equal(whole.counts([t])[0], small.counts([t])[0])
