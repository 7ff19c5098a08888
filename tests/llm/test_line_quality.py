"""Figures of texts against plain code, and the rules on single lines."""

import random
import re

from tidemark.llm.line_quality import clean_text, line_fails, line_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in repeated for j in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_figures(spark):
    r = random.Random(2)
    parts = ["a", "bé", "c.", "#x", "**", "\n", "\n", " \t", "\x0b", " ", "a b c", "\x1f", "中文"]
    texts = [r.choice([" ", "\n"]).join(r.choice(parts) for _ in range(r.choice([0, 1, 5, 60, 130]))) for _ in range(60)]
    texts += [None, "", "one two three four", "x " * 300, "a\na\n \n \na"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(0, texts[0], "z"), (None, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = line_quality(df).collect()
    found = sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str
    )
    assert found == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert not any(r.kept and r.base_failed for r in got)
    assert line_quality(df.limit(0)).count() == 0


def test_rules():
    def fails(line):
        return line_fails(line, line.split())

    assert fails("home | about | news | contact | help") == "navigation"
    assert fails("one### two&&& three$$$ four*** five") == "punctuation"
    assert fails("THIS! IS! LOUD! AND! LONG!") == "punctuation"
    assert fails("Accept all cookies to go on") == "boilerplate"
    for line in ("A heading without an end", "def f(x): return x * 2", "Licensed under the Apache License, Version 2.0.", "Ça va."):
        assert fails(line) is None
    assert clean_text("One line.\nhome | a | b | c\n\nOne line.\nLast.") == "One line.\n\nLast."


def test_verdict(spark):
    good = " ".join(f"word{i} goes on." for i in range(30))
    menu = "\n".join(f"home {i} | news | shop | help | more" for i in range(40))
    rows = [(1, good), (2, menu), (3, good + "\n" + menu), (4, good + "\nhome | news | shop | help")]
    kept = {r.doc_id: r.kept for r in line_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: True}
