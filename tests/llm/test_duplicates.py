"""N-gram groups, repeated passages and repeated lines against brute force."""

import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from reference_words import spaced

from delaylens.llm import linededup, ngramjoin, scratch, substrings, words


def shingles(text):
    w = spaced(text, True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            parent[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_groups_match_all_pairs(documents, odd_rows):
    found = [tuple(r) for r in ngramjoin.jaccard_groups(documents(odd_rows)).collect()]
    assert order(found) == order(groups(odd_rows))


def test_groups_of_many_edited_copies(documents):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(200):
        text = list(base)
        for _ in range(int(rng.integers(1, 6))):
            text[int(rng.integers(100))] = f"v{rng.integers(10**6)}"
        rows.append((i, " ".join(text)))
    found = [tuple(r) for r in ngramjoin.jaccard_groups(documents(rows)).collect()]
    assert order(found) == order(groups(rows))


def test_rows_without_a_key_meet_their_own_class_only(documents, monkeypatch, tmp_path):
    plain, log = ngramjoin._segmented, str(tmp_path / "rows")

    def counted(size, fold):
        run = plain(size, fold)

        def seen(batches):
            for batch in batches:
                with open(log, "a") as f:
                    f.write(f"{batch.num_rows}\n")
                yield from run(iter([batch]))

        return seen

    monkeypatch.setattr(ngramjoin, "_segmented", counted)
    texts = [" ".join(f"w{t}x{j}" for j in range(40)) + f" end{c}" for t in range(15) for c in range(2)]
    ngramjoin.jaccard_groups(documents([(None, t) for t in texts])).collect()
    assert sum(map(int, open(log).read().split())) <= 2 * len(texts)


def test_one_of_each_group_stays(documents, odd_rows):
    docs = documents(odd_rows)
    kept = ngramjoin.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    # Equal ids with different texts are different rows; of equal rows one stays.
    expected = list(dict.fromkeys((r[0], r[1]) for r, g in zip(odd_rows, groups(odd_rows)) if g[1] == 0 or g[0] == g[2]))
    assert ids == sorted((i for i, _ in expected), key=lambda x: (x is None, x))


@pytest.mark.parametrize("column", [[], [None], ["", None, " "]])
def test_words_of_nothing(column):
    found = words.split(pa.array(column, pa.string()), words.blanks(), True)
    assert len(found.starts) == 0 and len(found.bounds) == len(column) + 1
    assert all(len(x) == 0 for x in words.grams(found, 3))


def test_words_across_pieces(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 16)
    texts = ["alpha beta  gamma", None, "x" * 100 + " delta", "É" * 30, "", " epsilon zeta\n", "a b c d e f g h i j k l m n o p"]
    found = words.split(pa.array(texts), words.blanks(), False)
    assert np.diff(found.bounds).tolist() == [len(spaced(t)) for t in texts]
    names = [w for t in texts for w in spaced(t)]
    prints = {}
    for name, p in zip(names, found.prints.tolist()):
        assert prints.setdefault(name, p) == p
    assert len(set(prints.values())) == len(prints)


def repeats(rows, size=13):
    first = {}
    for i, t, *_ in rows:
        w = spaced(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            first[g] = min(first.get(g, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t, *_ in rows:
        w, own = spaced(t), float("inf") if i is None else i
        keep = [True] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < own:
                keep[k : k + size] = [False] * size
        out.append((i, len(w), len(w) - sum(keep), " ".join(x for x, y in zip(w, keep) if y)))
    return out


@pytest.mark.parametrize("block", [50, 4_000_000])
def test_repeats_match_all_windows(documents, odd_rows, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    found = substrings.remove_repeats(documents(odd_rows)).collect()
    assert order([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found]) == order(repeats(odd_rows))
    for r in found:
        covered = {k for s in r.spans for k in range(s.first_word, s.end_word)}
        assert len(covered) == r.n_removed and all(r.doc_id is None or s.reference < r.doc_id for s in r.spans)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_match_all_pairs(documents):
    rng = np.random.default_rng(8)
    bases = ["".join(rng.choice(list("abcde "), 60)).strip() for _ in range(6)]
    lines = []
    for b in bases:
        for _ in range(6):
            at = int(rng.integers(len(b)))
            lines.append([b, b[:at] + "Z" + b[at + 1 :], b[:at] + b[at + 1 :], b[:at] + "YY" + b[at:]][int(rng.integers(4))])
    rows = [(i, "\n".join(["", *rng.choice(lines, 4), "ab", f"only in {i} and nowhere else"])) for i in range(20)]
    for i, n in enumerate((19, 20, 21, 31, 32, 33, 63, 64, 65)):  # lengths around powers of two
        base = "".join(rng.choice(list("fghij"), n))
        cuts = [base, base[1:], base[:-1], base[: n // 2] + base[n // 2 + 1 :], "Z" + base[1:], base[:-1] + "Z", base + "Z"]
        rows += [(40 + 10 * i + j, x) for j, x in enumerate(cuts)]
    rows += [(30, None), (31, ""), (None, bases[0]), (32, "ab\r\n ab\t\nac"), (32, "ab")]
    seen = sorted({x.strip(" \t\r") for _, t in rows for x in (t or "").split("\n")} - {""})
    label = {x: x for x in seen}
    for a, b in combinations(seen, 2):
        if min(len(a), len(b)) >= 20 and distance(a, b) <= 1:
            old, new = label[b], label[a]
            label = {k: new if v == old else v for k, v in label.items()}
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if x.strip(" \t\r"):
                c = label[x.strip(" \t\r")]
                first[c] = min(first.get(c, float("inf")), key(i))
    expected = []
    for i, t in rows:
        gone, own = [], set()
        for p, x in enumerate(t.split("\n") if t is not None else []):
            x = x.strip(" \t\r")
            if x and (first[label[x]] < key(i) or label[x] in own):
                gone.append(p)
            own.add(label.get(x))
        expected.append((i, len(t.split("\n")) if t is not None else 0, len(gone), gone))
    docs = documents(rows)
    found = linededup.repeated_lines(docs).drop("_row").collect()
    assert order([tuple(r) for r in found]) == order(expected)
    kept = linededup.remove_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def edited(rng, line, edits):
    for at in rng.integers(len(line), size=edits).tolist():
        line = [line[:at] + "Z" + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + "Y" + line[at:]][int(rng.integers(3))]
    return line


def test_lines_with_edits_in_proportion_to_length_match_all_pairs(documents):
    rng = np.random.default_rng(5)
    lines = set()
    for n in (20, 62, 63, 64, 65, 96, 130, 161):
        base, k = "".join(rng.choice(list("abcdeé"), n)), max(1, n // 32)
        bunched = [base[: n // 3] + "Q" * k + base[n // 3 + k :], base[k:], base[: n - k] + "Q" * k]
        lines |= {base, *bunched, *(edited(rng, base, e) for e in range(1, k + 2) for _ in range(2))}
    lines = sorted(x for x in lines if len(x) >= 20)
    apart = {(a, b): distance(a, b) for a, b in combinations(lines, 2) if abs(len(a) - len(b)) <= 6}
    docs = documents([(i, x) for i, x in enumerate(lines)])
    ids = {r.line_id: r.line for r in linededup._lines(docs, "text", "doc_id").collect()}
    found = {frozenset((ids[r.a], ids[r.b])) for r in linededup.line_links(docs, per=32).collect()}
    near = {frozenset(pair) for pair in apart if apart[pair] <= max(1, max(map(len, pair)) // 32)}
    assert found == near and any(apart[pair] > 1 for pair in apart if frozenset(pair) in near)
    notice = "a notice of some ninety characters, which is the same in all documents but for its date: "
    docs = documents([(1, notice + "2001"), (2, notice + "2012"), (3, notice + "2999")])
    kept = {r.doc_id: r.text for r in linededup.remove_lines(docs, per=32).collect()}
    assert kept == {1: notice + "2001", 2: "", 3: notice + "2999"}
    with pytest.raises(ValueError):
        linededup.line_links(docs, per=5)
    plan = linededup.repeated_lines(docs, per=32)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_keys_are_dealt_with_in_passes(documents, monkeypatch):
    # 100 lines of two segments and 10 of eight: the first segments of all make the most keys.
    lines = {2: 100, 8: 10}
    assert linededup._passes(lines, 10**9) == [range(8)] and linededup._passes({}, 1) == [range(1)]
    passes = linededup._passes(lines, 500)
    assert [j for numbers in passes for j in numbers] == list(range(8)) and len(passes) > 2
    keys = lambda numbers: sum(2 * (j + 1) * sum(n for segments, n in lines.items() if segments > j) for j in numbers)
    assert all(len(numbers) == 1 or keys(numbers) <= 500 for numbers in passes)

    rng = np.random.default_rng(6)
    bases = ["".join(rng.choice(list("abcde "), n)).strip() for n in (70, 300, 700, 1100)]
    docs = documents([(i, edited(rng, b, e)) for i, (b, e) in enumerate((b, e) for b in bases for e in (0, 1, 2, len(b) // 32))])
    links = lambda: sorted(map(tuple, linededup.line_links(docs, per=32).collect()))
    whole = links()
    monkeypatch.setattr(linededup, "KEYS", 1)
    monkeypatch.setattr(linededup, "LINE_KEYS", 1)
    assert whole and links() == whole


def test_shuffle_files_of_stored_tables_go(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in map(str, (b.toString() for b in blocks())) if f.startswith("shuffle_")}

    def blocks():
        found = manager.getAllBlocks()
        return (found.apply(i) for i in range(found.size()))

    before, given = files(), spark.conf.get(scratch.TIDY, None)
    dealt = spark.range(10_000).repartition(5, "id")
    kept = scratch.Scratch(spark, "kept").store(dealt)
    assert files() - before
    before = files()
    stored = scratch.Scratch(spark, "tidy", tidy=True).store(spark.range(10_000).repartition(7, "id"))
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(scratch.TIDY, None) == given
    assert stored.count() == kept.count() == 10_000


def test_lines_are_taken_out_beside_clashing_columns(spark):
    line = "a line that is long enough"
    rows = [(1, f"{line}\nx", "r1", 1, "o"), (2, f"y\n{line}", "r2", 2, "o"), (2, f"y\n{line}", "r3", 3, "o"), (3, None, "r4", 4, "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed string, _row int, _own string")
    kept = sorted(map(tuple, linededup.remove_lines(docs).collect()))
    assert linededup.remove_lines(docs).columns == docs.columns
    assert kept == sorted([rows[0], (2, "y", "r2", 2, "o"), (2, "y", "r3", 3, "o"), rows[3]])


def test_line_plan_has_no_python(documents, odd_rows):
    plan = linededup.repeated_lines(documents(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(documents):
    docs = documents([]).repartition(1)
    assert ngramjoin.jaccard_groups(docs).count() == 0
    assert ngramjoin.one_of_each_group(docs).count() == 0
    assert substrings.remove_repeats(docs).count() == 0
    assert linededup.repeated_lines(docs).count() == 0
