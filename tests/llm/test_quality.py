import re
from collections import Counter, defaultdict

from spindrift.llm.quality import MIN_WORDS, judge, keep_good


def test_against_plain_rules(docs, texts):
    want = Counter()
    lines_of, hosts = defaultdict(set), Counter()
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    host = lambda i: "" if i == 20 else f"src{(i or 0) % 3}"
    has = lambda x: re.search(r"[^\x20\x09-\x0D]", x)
    for row, (i, t) in enumerate(texts):
        hosts[host(i)] += 1
        for x in (t or "").split("\n"):
            if has(x):
                lines_of[host(i), norm(x)].add(row)
    common = {k for k, v in lines_of.items() if len(v) > 2 and len(v) > 0.1 * hosts[k[0]]}
    assert common
    for i, t in texts:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        rep = len({k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)})
        lines = [x for x in t.split("\n") if has(x)]
        gone = sum(len(norm(x).split(" ")) for x in lines if (host(i), norm(x)) in common)
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, gone, failed, not failed and len(w) - gone >= MIN_WORDS] += 1
    rows = judge(docs, min_documents=2).collect()
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_line_words base_failed kept".split()
    assert Counter(tuple(r[n] for n in names) for r in rows) == want


def test_kept_rows_lose_frequent_lines(spark):
    rows = [(i, f"word{i} " * 3 + " ".join(f"t{i}x{k}" for k in range(12)) + "\nthe same line on every page", "s", 0, "z") for i in range(40)]
    rows += [(100, "too short", "s", 9, "z"), (101, "Apart from the SAME  line on every page", "s", 3, "z"), (102, "The same line  on every page\na b c d e f g", "s", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, _frequent string")
    kept = {r.doc_id: r for r in keep_good(docs).collect()}
    assert set(kept) == set(range(40))
    assert all("same line" not in r.text and r.n_chars == len(r.text) and r._frequent == "z" for r in kept.values())


def test_lines_are_counted_by_documents(spark):
    """A line on 30 copies of a page counts 30 times; a line that one document has 30 times counts once; other hosts don't count."""
    page = "\n".join(" ".join(f"l{k}w{j}" for j in range(9)) for k in range(5))
    own = lambda i: " ".join(f"t{i}x{k}" for k in range(12))
    rows = [(i, page, "s") for i in range(30)] + [(100, "again and again\n" * 30 + own(100), "s")] + [(200 + i, own(i) + "\n" + page.split("\n")[0], "other") for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in keep_good(docs, chars_col=None).collect()}
    assert set(kept) == {r[0] for r in rows if r[2] == "other"}  # 100 fails for its repeated words
    words = {r.doc_id: r.n_line_words for r in judge(docs).collect()}
    assert words[0] == 45 and words[100] == 0 and words[200] == 0


def test_crowded_lines_change_nothing(docs, monkeypatch):
    from spindrift.llm import joins

    found = lambda: Counter((r.doc_id, r.n_line_words, r.kept) for r in judge(docs, min_documents=2).collect())
    whole = found()
    monkeypatch.setattr(joins, "CROWDED", 4)
    assert found() == whole and sum(n for _, n, _ in whole) > 0


def test_helper_names_may_be_taken(spark):
    rows = [(None, " ".join(f"w{i}" for i in range(20)), "s", 5, "a", 7, "b"), (1, "short", "s", 5, "a", 7, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, hash int, host string, id int, frequent string")
    assert list(map(tuple, keep_good(df, chars_col=None).collect())) == rows[:1]


def test_empty(none):
    assert judge(none).count() == 0 and keep_good(none).count() == 0
