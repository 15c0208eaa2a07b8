"""Quality rules, language identification and the removal of repeats."""

import random
from collections import Counter

import numpy as np
import pytest

from encore.llm import language, line_templates, quality, sentence_spans

VOCABULARY = {
    "en": ["the", "of", "and", "to", "house", "water", "thing", "with", "which", "that"],
    "de": ["der", "die", "und", "zu", "haus", "wasser", "ding", "mit", "welche", "dass"],
    "fr": ["le", "la", "et", "de", "maison", "été", "chose", "avec", "que", "où"],
}


def prose(rng, lang, n):
    return " ".join(rng.choice(VOCABULARY[lang]) for _ in range(n))


def corpus():
    rng = random.Random(8)
    return [(i, prose(rng, lang, rng.randint(60, 200)) + ".", lang)
            for i in range(150) for lang in [rng.choice(list(VOCABULARY))]]


def base(text):
    words = [w for w in _split(text or "")]
    triples = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if triples[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if _split(line):
            duplicates += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, duplicates, len(hit)


def _split(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def test_quality(spark, docs_of):
    good = corpus()
    rng = random.Random(1)
    junk = [(500 + i, " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in
                               prose(rng, "en", 120).split()), "en") for i in range(5)]
    rare = [(600 + i, " ".join(f"{chr(97 + j % 26)}q{chr(97 + j // 26)}zx" for j in range(120)), None)
            for i in range(3)]
    odd = [(700, None, "en"), (701, "", "en"), (702, "a\u00a0b\u2028c é\n\na\u00a0b\n \t\na\u00a0b", None),
           (703, "same line\nsame line\n" * 40, None), (704, "x y z w " * 9, "en"), (None, "a b", None),
           (705, "word " * 30_000, "fr")]
    rows = good + junk + rare + odd + good[:2]
    docs = docs_of(rows)
    got = quality.judge(docs).collect()
    want = Counter((r[0], *base(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
        assert not (r.kept and r.base_failed)
        assert 0 <= r.char_distance <= 1 and 0 <= r.word_distance <= 1
    by = {r.doc_id: r for r in got}
    assert all(by[i].char_distance > 0.3 for i, *_ in junk)
    assert all(not by[i].kept and not by[i].base_failed for i, *_ in rare)
    assert quality.judge(docs.limit(0)).count() == 0
    unlabelled = quality.judge(docs_of([(1, " ".join(f"w{i}" for i in range(60)))]))
    assert unlabelled.first().kept


def test_reference_counts_are_exact(spark, docs_of):
    rows = [r for r in corpus() if r[2] == "en"]
    found = quality.references(docs_of(rows).repartition(7))
    counts = Counter(w for r in rows for w in r[1].lower().replace(".", " ").split())
    total = sum(counts.values())
    shares = sorted(n / total for n in counts.values() if n / total >= quality.COMMON_SHARE)
    assert sorted(found.words[0][:-1]) == pytest.approx(shares)


def test_distance_is_jensen_shannon():
    p, q = np.array([[1.0, 0, 0]]), np.array([[0, 0.5, 0.5]])
    assert quality.distances(p, q)[0] == pytest.approx(1.0)
    assert quality.distances(q * 4, q)[0] == pytest.approx(0.0, abs=1e-7)


def test_language(spark, docs_of):
    rng = random.Random(5)
    rows = [(i, prose(rng, lang, rng.randint(15, 60)), lang)
            for i in range(400) for lang in [rng.choice(list(VOCABULARY))]]
    odd = [(1000, None, "en"), (1001, "123 ... 4", "en"), (1002, "", None), (None, "the of and", None),
           (1003, "the house of water " * 5000, None), (1004, "ÜBER", "xx")]
    docs = docs_of(rows + odd + rows[:1])
    got = language.identify(docs).collect()
    assert len(got) == len(rows) + len(odd) + 1
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert by[i].lang_pred == "und" and by[i].score == 0 and by[i].ambiguous
    assert by[1003].lang_pred == "en" and all(0 <= r.score <= 1 for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got
               if r.doc_id is not None)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in got} - {r.doc_id for r in kept.collect()}
    assert {1000, 1001, 1002} <= gone and len(gone) < 20
    none = language.identify(docs_of([(1, "abc")]))
    assert none.first().lang_pred == "und"
    assert language.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len(code) == n
    if n > 1:
        assert len({tuple(c) for c in code}) == n and all(len(set(c)) == 2 for c in code.T)


def test_repeated_spans(spark, docs_of):
    rng = random.Random(3)
    word = iter(f"k{i}" for i in range(10**6))
    sentence = lambda n: " ".join(next(word) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(rng.randint(8, 14)) for _ in range(6))  # over 50 words
    rows = []
    for i in range(60):
        own = [sentence(rng.randint(3, 15)) for _ in range(8)]
        if i % 3 == 0:
            own.insert(rng.randint(0, 8), passage)
        rows.append((i, rng.choice([" ", "\n"]).join(own)))
    rows += [(100, rows[1][1]), (101, None), (102, ""), rows[2], (1, "other text here."),
             (103, "Short one. Short one. Short one."), (None, passage)]
    got = sentence_spans.remove_repeats(docs_of(rows))
    assert got.count() == len(rows)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert by[None][0].n_removed == 0  # documents without id come first
    for i in range(60):
        r = by[i][0]
        if i % 3 == 0:
            assert r.n_removed == 6 and passage.split(". ")[1] not in r.text
            assert len(r.text.split()) + r.n_words_removed == len(dict(rows[:60])[i].split())
        elif i != 1:
            assert r.n_removed == 0 and r.text == dict(rows[:60])[i]
    assert by[100][0].n_removed == by[100][0].n_sentences and by[100][0].text == ""
    assert by[101][0].text is None and by[102][0].text == ""
    assert by[103][0].n_removed == 0 and len(by[2]) == 2 and by[2][0].n_removed == 0
    assert sentence_spans.remove_repeats(docs_of(rows).limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [(12, 12, 5), (25, 25, 8), (5, 12, 12), (7, 3, 30, 1, 1)])
def test_repeats_go_to_the_last_sentence(spark, docs_of, monkeypatch, sizes):
    word = iter(f"k{i}" for i in range(10**6))
    sentence = lambda n: " ".join(next(word) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(n) for n in sizes)
    own = [[sentence(9), sentence(30), sentence(4)] for _ in range(30)]
    rows = [(i, " ".join([*a[:2], passage, a[2]])) for i, a in enumerate(own)]
    rows += [(50, rows[0][1]), (51, "\n " + passage), (60, "Ends early. " + passage),
             (70, "Read this."), (71, "read  this.")]
    for hot in (10, 1000):  # the passage is hot in the sample, or nothing is
        monkeypatch.setattr(sentence_spans, "HOT_IN_SAMPLE", hot)
        by = {r.doc_id: r for r in sentence_spans.remove_repeats(docs_of(rows)).collect()}
        assert by[0].text == rows[0][1] and by[70].text == "Read this."
        for i in range(1, 30):
            assert by[i].text == " ".join(own[i]) and by[i].n_removed == len(sizes)
            assert by[i].n_words_removed == sum(sizes)
        assert by[60].text == "Ends early. "
        assert by[50].text == by[51].text == by[71].text == ""


@pytest.mark.parametrize("seed", range(4))
def test_spans_equal_all_runs(spark, docs_of, seed):
    """Sentences that any repeated run of 20 words or more covers, from all runs in plain Python."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randint(1, 16)))
            + "." for _ in range(40)]
    rows = []
    for i in range(25):
        parts = [rng.choice(pool) for _ in range(rng.randint(1, 9))]
        if i and rng.random() < 0.7:
            other = rng.choice(rows)[1].split(". ")
            a = rng.randrange(len(other))
            parts[1:1] = [p.rstrip(".") + "." for p in other[a : a + rng.randint(1, 6)]]
        rows.append((i, " ".join(parts)))
    seen, want = set(), {}
    for i, text in rows:
        parts = [s.lower().split() for s in sentence_spans.sentences(text)]
        gone = set()
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                run = tuple(w for p in parts[a:b] for w in p)
                if len(run) >= 20 or b - a == len(parts):
                    if run in seen:
                        gone |= set(range(a, b))
                    seen.add(run)
        want[i] = len(gone)
    got = sentence_spans.remove_repeats(docs_of(rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == want and sum(want.values()) > 5


def test_sentences_join_to_the_text():
    for text in ["A b. C d! E?\n\nF g", "no end", "", "x.y z. “Q.” r…", "\n\n", "a. \n b"]:
        assert "".join(sentence_spans.sentences(text)) == text


def test_line_templates(spark, docs_of):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        own = [" ".join(f"u{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}x"
                        for _ in range(rng.randint(6, 12))) for _ in range(3)]
        own.insert(1, f"page {i} of {i * 7} printed on 2020-01-{i:02d} by system")
        if i % 2:
            own.append("All rights reserved by the owner.")
        own.append("hi there")
        rows.append((i, "\n".join(own)))
    rows += [(100, rows[0][1]), (101, None), (102, ""), rows[1], (None, rows[1][1])]
    got = line_templates.dropped_lines(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows).get(r.doc_id) if r.doc_id is not None else rows[1][1]
        lines = text.split("\n") if text is not None else []
        want = [k for k, x in enumerate(lines) if x.startswith(("page ", "All rights"))]
        assert r.n_lines == len(lines) and list(r.dropped) == want and r.n_dropped == len(want)
    few = line_templates.dropped_lines(docs_of(rows[:9] + [(50, rows[0][1])]))
    assert few.agg({"n_dropped": "sum"}).first()[0] == 0  # copies count once
    clean = line_templates.without_dropped(docs_of(rows))
    assert clean.columns == docs_of(rows).columns
    assert clean.where("text like '%rights reserved%'").count() == 0
    assert clean.count() == len(rows)
    assert line_templates.dropped_lines(docs_of(rows).limit(0)).count() == 0
    plan = line_templates.dropped_lines(docs_of(rows))._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()


@pytest.mark.parametrize("seed", range(2))
def test_leaf_with_several_templates(spark, docs_of, seed):
    rng = random.Random(seed)
    word = iter(f"v{chr(97 + i // 676 % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}"
                for i in range(17_576))
    kinds = ["This page is kept by the archive of {}", "This page is old so please read {} instead",
             "This page is one of {} on our site", "This page is made for you with {} care"]
    rows, planted = [], {}
    for i in range(130):
        lines = [f"This page is {next(word)} {next(word)} {next(word)} {next(word)} {next(word)} "
                 f"{next(word)}" for _ in range(2)]  # as many tokens as the templates have
        kind = kinds[i % 4]
        filler = next(word) if i % 4 else "all"  # the first kind is the same line
        line = kind.format(filler)
        at = rng.randrange(3)
        lines.insert(at, line + " x" * (9 - len(line.split())))
        rows.append((i, "\n".join(lines)))
        planted[i] = [at]
    got = line_templates.dropped_lines(docs_of(rows)).collect()
    assert {r.doc_id: list(r.dropped) for r in got} == planted


def test_line_of_enough_texts_goes(spark, docs_of):
    """Every masked line of three tokens or more in ten texts, whatever else its leaf holds."""
    rng = random.Random(4)
    pool = [f"we also have {a} {b} {c}" for a in "abcdef" for b in "ghijk" for c in "lmnop"]
    rows = [(i, "\n".join(rng.choices(pool, range(1, len(pool) + 1), k=6))) for i in range(120)]
    texts = Counter(x for _, t in rows for x in set(t.split("\n")))
    assert 5 < sum(n >= 10 for n in texts.values()) < len(texts) - 5
    for r in line_templates.dropped_lines(docs_of(rows)).collect():
        often = {k for k, x in enumerate(dict(rows)[r.doc_id].split("\n")) if texts[x] >= 10}
        assert often <= set(r.dropped)


def test_lines_are_hashed_before_their_texts_are_compared(spark):
    from encore.llm import line_templates

    rows = [(1, 10, "a b c")] * 5 + [(1, 11, "x"), (1, 11, "y"), (2, 10, "a b c")]
    once = line_templates._once(spark.createDataFrame(rows, "leaf long, line long, masked string"))
    assert sorted(map(tuple, once.collect())) == [(1, 10, "a b c"), (1, 11, "y"), (2, 10, "a b c")]
    plan = once._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    first = [x for x in plan.splitlines() if "Aggregate" in x][-1]  # the one next to the rows
    assert "HashAggregate" in first and "SortAggregate" not in first
