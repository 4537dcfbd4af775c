"""Line dedup: automaton, windows, brute force, hot buckets, edges."""
import random

from llm import lines

from corpus_cases import DOCS


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        k, i = rng.randrange(3), rng.randrange(len(s) + 1)
        if k == 0:
            s.insert(i, rng.choice("abé"))
        elif s:
            i %= len(s)
            if k == 1:
                del s[i]
            else:
                s[i] = rng.choice("ab\U0001f600")
    return "".join(s)


def test_automaton_and_windows():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, rng.randint(0, 4))
        d = distance(a, b)
        for most in (0, 1, 2, 3):
            assert lines.edits_within(a, b, most) == (d if d <= most else None), (a, b, most)
        x, y = sorted((a, b), key=len)
        if d <= 2 and len(x) > 2:  # a segment of the shorter one is found in the longer one
            own = {(len(x), i, x[s:s + n]) for i, (s, n) in enumerate(lines.segments(len(x), 3))}
            probe = {(o, i, y[s:s + n]) for o, i, s, n in lines.windows(len(y), 2)}
            probe |= {(len(y), i, y[s:s + n]) for i, (s, n) in enumerate(lines.segments(len(y), 3))}
            assert own & probe, (x, y)


def brute(rows, max_edits=2, similarity=0.8, min_words=5):
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r))
    before, out = [], {}
    for r in order:
        for n, x in lines._lines(rows[r][1], min_words):
            if any(distance(x, y) <= min(max_edits, int((1 - similarity) * max(len(x), len(y)) + 1e-9)) for y in before if abs(len(x) - len(y)) <= max_edits):
                out.setdefault(r, []).append(n)
            before.append(x)
    return {r: (["\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in out.get(r, []))][0] if t is not None else None) for r, (_, t) in enumerate(rows)}


def test_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5)))
    base = [" ".join(word() for _ in range(rng.randint(3, 8))) for _ in range(25)]
    rows = []
    for i in range(60):
        own = [edited(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 5))]
        rows.append((i * 7 % 60, "\n".join(own)))
    rows += [(None, base[0] + "\n\n  " + base[1] + "  \nshort line"), (1000, None), (1001, "")]
    want = brute(rows)
    df = spark.createDataFrame([(i, t, "en", "s", r) for r, (i, t) in enumerate(rows)], DOCS).coalesce(1)
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    assert {r.n_chars: r.text for r in out.collect()} == want


def test_hot_bucket(spark):
    """More near copies of one line than a block holds, and lines that share a segment only."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    near = [base[:-3] + f"{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{i // 676}" for i in range(1400)]
    df = spark.createDataFrame([(i, t + "\nkept", "", "", 0) for i, t in enumerate([base, *near])], DOCS)
    got = lines.dedup_lines(df).filter("text like '%one%'").collect()
    # a line stays if no earlier one differs in at most two of its last three letters
    keep = [t for i, t in enumerate([base, *near]) if not any(lines.near(t, u, 2, 0.8) for u in [base, *near][:i])]
    assert sorted(r.text.split("\n")[0] for r in got) == sorted(keep)


def test_edges(spark):
    long_line = "word " * 100000
    rows = [(1, "a b c d e\na b c d e\nx", 1), (1, "a b c d e", 2), (2, long_line + "\n" + long_line[:-1] + "z", 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, line int")
    got = {r.line: (r.text, r.n_lines, r.dropped_lines) for r in lines.dedup_lines(df.coalesce(1), report=True).collect()}
    assert got[1] == ("a b c d e\nx", 3, [1]) and got[2] == ("", 1, [0]) and got[4] == (None, 0, [])
    assert got[3][1:] == (2, [1])
    assert lines.dedup_lines(df.filter("false")).count() == 0
