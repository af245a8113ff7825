import random
import re
from itertools import combinations

from chatterscope.llm.line_dedup import line_report, removals, without_repeated_lines


def normal(line):
    return re.findall(r"[^\W_]+", line.lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, min_words=5, similarity=0.9):
    """Lines that go by edit similarity alone, whatever finds the pairs; those of few words by exact repeats."""
    lines = [(i, at, " ".join(w)) for i, t in docs if t is not None for at, line in enumerate(t.split("\n")) if (w := normal(line))]
    low = {t: t for _, _, t in lines}

    def root(t):
        while low[t] != t:
            t = low[t]
        return t

    for a, b in combinations([t for t in low if t.count(" ") >= min_words - 1], 2):
        most = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
        if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
            low[root(b)] = root(a)
    first, gone = {}, {}
    for i, at, t in sorted(lines):
        if first.setdefault(root(t), (i, at)) != (i, at):
            gone.setdefault(i, []).append(at)
    return gone


def cases():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randrange(2, 9)))
    pool = [[word() for _ in range(rng.randrange(3, 60))] for _ in range(25)]
    docs = []
    for k in range(50):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = list(rng.choice(pool))
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = word()
            line = rng.choice([" ", ", ", "  - "]).join(words)
            lines.append(line.upper() if rng.random() < 0.3 else line)
        docs.append((k, "\n".join(lines)))
    return [*docs, (90, None), (91, ""), (92, "\n\n \n"), (93, "a b c d e\na b c d e\nA, b; c-d E!"), (94, "ab " * 3000 + "\n" + "ab " * 3000)]


def test_removals_against_brute_force(spark, make_docs):
    """Nothing goes that edit similarity keeps; of what it lets go, the keys of the least hashes find 132 of 133 here."""
    docs = cases()
    got = {r.doc_id: r.removed for r in removals(spark, make_docs(docs, clashing=True).repartition(3)).collect()}
    expected = brute(docs)
    mine, theirs = ({(i, at) for i, v in x.items() for at in v} for x in (got, expected))
    assert mine <= theirs and len(mine) >= 0.99 * len(theirs) > 100
    exact = brute(docs, similarity=1.0)
    assert {(i, at) for i, v in exact.items() for at in v} <= mine
    assert expected[93] == got[93] == [1, 2] and any(len(v) > 1 for v in expected.values())
    report = {r.doc_id: (r.n_removed, r.removed_lines) for r in line_report(spark, make_docs(docs)).collect()}
    assert report == {i: (len(got.get(i, [])), ",".join(map(str, got.get(i, [])))) for i, _ in docs}


def test_texts_without_the_lines(spark, make_docs):
    line = "this very sentence stands in several documents of the corpus"
    docs = make_docs([(1, f"top\n{line}\nend"), (2, f"{line}.\nother"), (3, line), (4, None), (5, "")], clashing=True)
    got = without_repeated_lines(spark, docs)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {1: (f"top\n{line}\nend", 68), 2: ("other", 5), 3: ("", 0), 4: (None, None), 5: ("", 0)}


def test_empty_and_repeated_rows(spark, make_docs):
    assert line_report(spark, make_docs([])).collect() == []
    line = "one two three four five six"
    rows = line_report(spark, make_docs([(1, line), (1, line), (2, line), (None, line)])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 0), (1, 0), (1, 0), (2, 1)]


def alike(docs, min_words=5, similarity=0.9):
    """Lines that go by edit similarity alone, whatever finds the pairs."""
    lines = [(i, at, " ".join(w)) for i, t in docs if t for at, line in enumerate(t.split("\n")) if len(w := re.findall(r"[^\W_]+", line.lower())) >= min_words]
    low = {t: t for _, _, t in lines}

    def root(t):
        while low[t] != t:
            t = low[t]
        return t

    for a, b in combinations(low, 2):
        most = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
        if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
            low[root(b)] = root(a)
    first = {}
    return {(i, at) for i, at, t in sorted(lines) if first.setdefault(root(t), (i, at)) != (i, at)}


def gone(spark, docs):
    return {(r.doc_id, at) for r in removals(spark, docs).collect() for at in r.removed}


def test_lines_with_a_changed_word_are_found(spark, make_docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    docs = []
    for k in range(60):
        words = [word() for _ in range(rng.randrange(10, 40))]
        docs.append((2 * k, " ".join(words)))
        words[rng.randrange(len(words))] = word()
        docs.append((2 * k + 1, " ".join(words)))
    expected, got = alike(docs), gone(spark, make_docs(docs))
    assert len(expected) > 50 and got <= expected
    assert len(got) >= 0.95 * len(expected)


def test_typographic_marks_do_not_keep_copies(spark, make_docs):
    plain = 'he said "one word" and went-off to another place, quickly'
    marked = "he said “one word” and went—off to another place。 quickly…"
    short = "we go on to the end of it"
    docs = [(1, plain), (2, marked), (3, short), (4, short.replace(" on ", " on—")), (5, "déjà vu à la carte"), (6, "déjà vu «à la» carte")]
    assert gone(spark, make_docs(docs)) == {(2, 0), (4, 0), (6, 0)} == alike(docs)


def test_long_lines_are_measured_like_short_ones(spark, make_docs):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(2500)]
    other, near = words[1250:] + words[:1250], [*words[:700], "instead", *words[702:1900], *words[1901:], "end"]
    docs = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(near)), (4, "x " + " ".join(words[1:-1])), (5, " ".join(words[:5])), (6, "z " + " ".join(words[:5]))]
    assert len(docs[0][1]) > 10_000
    assert gone(spark, make_docs(docs)) == {(3, 0), (4, 0), (6, 0)}


def test_short_lines_and_scripts_without_blanks(spark, make_docs):
    chinese = "今天的天气非常好我们决定一起去公园散步看花"
    docs = [(1, f"home\nabout us\n\n--\n{chinese}"), (2, "Home!\nabout  us\n\n--\nabout it"), (3, chinese), (4, chinese.replace("散", "跑") + "。")]
    assert gone(spark, make_docs(docs)) == {(2, 0), (2, 1), (3, 0), (4, 0)}


def test_copies_of_a_frequent_line_are_not_all_paired(spark, make_docs, monkeypatch):
    """Each line differs from the frequent one by less than the limit, from each other by more. The first one is no hub."""
    from chatterscope.llm import line_dedup

    rng, pairs, star = random.Random(10), [], line_dedup.star_components
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=8))
    base, docs = [word() for _ in range(30)], []
    for k in range(80):
        words = list(base)
        if k % 4:
            for at in rng.sample(range(30), 2):
                words[at] = word()
        docs.append((k + 1, " ".join(words)))
    docs.append((0, " ".join([word(), *base[1:15], word(), word(), *base[17:]])))

    def watched(spark, buckets, possible, verify, **more):
        def verified(asked):
            pairs.append(asked.select("a", "b").count())
            return verify(asked)

        return star(spark, buckets, possible, verified, **more)

    monkeypatch.setattr(line_dedup, "star_components", watched)
    got, expected = gone(spark, make_docs(docs)), alike(docs)
    assert got == expected and len(expected) > 70
    assert sum(pairs) < 3 * len(docs)


def test_lines_that_no_hub_connects_become_no_rows(spark, make_docs, monkeypatch):
    """Lines end alike and begin too differently for a link; a few have a near copy. What no hub connects is not paired off."""
    from chatterscope.llm import line_dedup

    rng, asked, star = random.Random(11), [], line_dedup.star_components
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=8))
    end = [word() for _ in range(12)]
    lines = [[*(word() for _ in range(4)), *end] for _ in range(60)]
    lines += [[*x[:3], word(), *x[4:]] for x in lines[30:40]]
    docs = [(k, " ".join(x)) for k, x in enumerate(lines)]

    def watched(spark, buckets, possible, verify, **more):
        def verified(pairs):
            asked.append(pairs.select("a", "b").count())
            return verify(pairs)

        return star(spark, buckets, possible, verified, **more)

    monkeypatch.setattr(line_dedup, "star_components", watched)
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    got, expected = gone(spark, make_docs(docs)), alike(docs)
    assert got == expected == {(k, 0) for k in range(60, 70)}
    assert sum(asked) < 4 * len(docs)
