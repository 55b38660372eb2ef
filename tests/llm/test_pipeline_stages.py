"""Every stage of the pipeline against an independent version, on planted cases."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ebbline.llm.queries import word_vocabulary
from tests.llm.conftest import SF

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)
FIRST_TOXIC = 900_000


def fixture() -> list:
    """Plain texts of lines, some with a repeated passage; exact and near copies; toxic texts."""
    rng = np.random.default_rng(12)
    line = lambda: " ".join(f"w{i}" for i in rng.integers(0, 5000, 9))
    passage = "\n".join(line() for _ in range(4))
    texts = ["\n".join(line() for _ in range(12)) for _ in range(60)]
    for i in range(0, 30, 3):
        texts[i] += "\n" + passage + "\n" + line()
    texts += texts[:5]
    for i in range(10, 20):  # one word of one long line changes, so no three lines are repeated
        words = texts[i].replace("\n", " ").split(" ")
        texts.append(" ".join(words))
        words[int(rng.integers(len(words)))] = "changed"
        texts.append(" ".join(words))
    rows = [(500_000 + i, t, "en", "abc"[i % 3], len(t)) for i, t in enumerate(texts)]
    toxic = [f"you stupid idiot and pathetic loser, worthless scum and trash {i}" for i in range(8)]
    return rows + [(FIRST_TOXIC + i, t, "en", "a", len(t)) for i, t in enumerate(toxic)]


def without_repeated_lines(rows: list) -> list:
    seen, out = set(), []
    for row in sorted(rows):
        lines, gone = row[1].split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((row[0], text, *row[2:4], len(text)))
    return out


def fingerprint(text: str) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def without_close_prints(rows: list) -> list:
    """Of each group that links of at most 2 differing bits connect, the row of smallest doc_id."""
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    return [r for i, r in enumerate(rows) if group[i] == i]


def test_each_stage_equals_an_independent_version(spark):
    def run(name: str, rows: list) -> list:
        found = STAGE[name](spark, spark.createDataFrame(rows, SCHEMA), SF)
        return sorted(map(tuple, found.collect()))

    rows = sorted(fixture())
    clean = run("toxicity", rows)
    assert clean == [r for r in rows if r[0] < FIRST_TOXIC]
    lines = run("line_dedup", clean)
    assert lines == without_repeated_lines(clean) and lines != clean
    apart = run("simhash_dedup", lines)
    assert apart == without_close_prints(lines) and len(apart) <= len(lines) - 5
    mixed = run("source_mix", apart)
    words = {r[0]: WORD.findall(r[1]) for r in apart}
    size, taken = {}, {}
    for r in apart:
        size[r[3]] = size.get(r[3], 0) + len(words[r[0]])
    for doc_id, text, _, source, n_chars in mixed:
        found = WORD.findall(text)
        assert found == words[doc_id][: len(found)] and n_chars == len(text)
        taken[source] = taken.get(source, 0) + len(found)
    assert all(taken[s] <= 2 * n for s, n in size.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 32 * len(size)
    library, want = Tokenizer.from_file(word_vocabulary()), []
    for r in mixed:
        ids = library.encode(r[1], add_special_tokens=False).ids
        want.append((r[0], r[3], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    last = STAGE["bpe"](spark, spark.createDataFrame(mixed, SCHEMA), SF).select("doc_id", "source", "n_tokens", "ids_sha256")
    assert sorted(map(tuple, last.collect())) == sorted(want)
