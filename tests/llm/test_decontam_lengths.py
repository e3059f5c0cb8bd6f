"""Recall at exactly a fifth of edits, by the length of the item."""

import random

import pyarrow as pa
import pytest

from starflow.llm import decontam
from starflow.llm.common import PUNCTUATION, hash_words, texts_of


def changed(r, words, n, mixed):
    words = list(words)
    if not mixed:
        for k in r.sample(range(len(words)), n):
            words[k] = f"new{r.randrange(10**6)}"
        return words
    for _ in range(n):
        k = r.randrange(len(words))
        match r.randrange(3):
            case 0:
                words[k] = f"new{r.randrange(10**6)}"
            case 1:
                del words[k]
            case 2:
                words.insert(k, f"new{r.randrange(10**6)}")
    return words


def recall(n, mixed, trials=120):
    r = random.Random(n)
    word = lambda: f"w{r.randrange(3000)}"
    items = [[word() for _ in range(n)] for _ in range(trials)]
    block = decontam.Items(list(range(trials)), [" ".join(x) for x in items], 0.2)
    found = 0
    for k, item in enumerate(items):
        text = [word() for _ in range(r.randint(0, 60))] + changed(r, item, n // 5, mixed) + [word() for _ in range(r.randint(0, 60))]
        words, first = hash_words(*texts_of(pa.array([" ".join(text)])), PUNCTUATION)
        found += any(m[0] == k for m in decontam._matches(block, words, block.candidates(words, first)[:, 1:]))
    return found / trials


@pytest.mark.parametrize("mixed", [False, True])
@pytest.mark.parametrize("n", [1, 4, 5, 7, 8, 10, 11, 12, 15, 18, 20, 25, 29, 35, 39])
def test_no_short_item_is_missed(n, mixed):
    assert recall(n, mixed) == 1


@pytest.mark.parametrize("mixed", [False, True])
@pytest.mark.parametrize("n", [40, 45, 50, 60])
def test_longer_items_reach_the_target(n, mixed):
    assert recall(n, mixed) >= 0.95
