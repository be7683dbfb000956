import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fundlens.llm import spelling

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(rows):
    """Counts of the contract's words, by a loop over all runs."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_near(words):
    """All words exactly one edit apart, from the strings that one deletion leaves."""
    near, left = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            if short in words and short != w:
                near[w].add(short)
                near[short].add(w)
            left[short, i].add(w)
    for group in left.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain(rows):
    n = plain_words(rows)
    near = plain_near(n)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def pairs_of(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("block_words", [spelling.BLOCK_WORDS, 40])
def test_documents_equal_brute_force(documents, monkeypatch, block_words):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block_words)
    want = plain(pairs_of(documents.select("doc_id", "text").collect()))
    assert len(want) > 500 and any(r[1] for r in want)
    assert result(spelling.group(documents)) == want


def test_hot_prefixes_and_chains(spark, monkeypatch):
    """Many words share long beginnings or ends, longer than block borders; forms lead on."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 30)
    rng = random.Random(3)
    words = ["a" * 80 + "".join(rng.choices("ab", k=6)) for _ in range(60)]
    words += ["".join(rng.choices("ab", k=6)) + "z" * 80 for _ in range(60)]
    words += ["".join(rng.choices("abÿ", k=rng.randint(7, 9))) for _ in range(400)]
    words += ["ÿ" * k for k in range(7, 12)] + ["a" * k for k in range(7, 12)]
    rows = [(i, " ".join([w] * rng.choice([1, 2, 3, 40])) + " ") for i, w in enumerate(words)]
    rows += [(i, "chainword " * 700 + "chainwordx " * 60 + "chainwordxy " * 4) for i in range(900, 902)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert ("chainwordxy", "chainwordx", "chainword") in {r[:3] for r in want}
    assert result(spelling.group(df)) == want


def test_odd_rows(odd_documents):
    df = odd_documents.union(odd_documents)
    assert result(spelling.group(df)) == plain(pairs_of(df.collect()))
    assert result(spelling.group(df.limit(0))) == set()


def test_reaches_never_excludes_a_near_word():
    rng = random.Random(5)
    for _ in range(3000):
        word = bytes(rng.choices(b"ab", k=rng.randint(7, 10)))
        i = rng.randrange(len(word) + 1)
        kind = rng.randrange(3)
        other = word[:i] + bytes(rng.choices(b"abc", k=kind)) + word[i + (kind < 2):]
        if kind == 2:
            other = word[:i] + b"c" + word[i:]
        for k in range(len(other) + 1):
            assert spelling.reaches(word, other[:k])


def test_walk_skips_dead_ranges():
    words = sorted({bytes(random.Random(i).choices(b"abc", k=8)) for i in range(800)})
    listed = spelling.SortedList(words)
    for i in range(0, len(words), 7):
        for depth in range(1, 8):
            j = next((j for j in range(i + 1, len(words)) if words[j][:depth] != words[i][:depth]), len(words))
            assert listed.skip(np.array([i]), np.array([depth]))[0] == j
