import random

from sparktree.llm.linedupe import LineRuns, dedup_lines, line_keys

BLANK = " \t\n\x0b\x0c\r"
DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = line.strip(BLANK).translate(DOWN)
            if len(k) >= min_chars:
                held.setdefault(k, set()).add(i)
    rank = lambda i: (i is not None, i)
    gone = {k: max(v, key=rank) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not ((k := x.strip(BLANK).translate(DOWN)) in gone and gone[k] != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def ran(spark, rows, **how):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_lines int, drop string").repartition(3)
    return [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in dedup_lines(d, **how).collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [f"Line {k} of the pool, which is long enough to count, É {k * k}" for k in range(30)] + ["short"]
    rows = [(k, "\n".join(rnd.choice((str, str.upper))(rnd.choice(pool)) + rnd.choice(("", " ", "\t\r")) for _ in range(rnd.randint(0, 6)))) for k in range(60)]
    # lower-casing is of A-Z only, so É and é differ
    assert same(ran(spark, rows), brute(rows))


def test_odd_rows(spark):
    long = "x" * 40
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, long.upper() + "\n" + long), (6, " " + long + "\r"), (7, long), (7, long + "\nmore"), (8, long), (None, long), (9, "x" * 39), (10, " " + long)]
    assert same(ran(spark, rows), brute(rows))
    assert ran(spark, []) == []
    huge = "\n".join(f"{k:050d}" for k in range(20000))
    rows = [(k, huge) for k in range(5)]
    assert same(ran(spark, rows), brute(rows))


def test_runs_are_compacted_and_a_store_goes_on(spark):
    runs = LineRuns(spark, buckets=4, fanout=2)
    batches = [[(b * 10 + k, f"{'y' * 40}{(b + k) % 4 if k else 'z'}") for k in range(4)] for b in range(4)]
    entries = {}
    for n, rows in enumerate(batches):
        if n == 2:
            runs = LineRuns.open(spark, runs.path)
        runs.add(line_keys(spark.createDataFrame(rows, "doc_id long, text string")))
        for i, t in rows:
            entries.setdefault(t, set()).add(i)
        state = {bytes(r["h"]): (r["n_docs"], r["last_doc"]) for r in runs.state().collect()}
        assert sorted(state.values()) == sorted((len(v), max(v)) for v in entries.values())
    assert len(runs.runs()) < 4 and max(len(x) for x in runs.levels) < 2
    assert runs.repeated(4).count() == 1 and runs.repeated(5).count() == 0
    again = LineRuns.open(spark, runs.path)
    assert again.levels == runs.levels and again.state().count() == len(entries)


def test_the_anti_join_alone_enters_new_keys(spark, monkeypatch):
    frame = type(spark.range(0))
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, on=None, how=None: join(self, other, on, how).limit(0) if how == "left_anti" else join(self, other, on, how))
    runs = LineRuns(spark, buckets=2)
    for k, line in enumerate(("a" * 40, "b" * 40)):
        runs.add(line_keys(spark.createDataFrame([(k, line)], "doc_id long, text string")))
    assert runs.state().count() == 1


def test_older_runs_are_never_exchanged(spark):
    runs = LineRuns(spark, buckets=4, fanout=9)
    for k in range(3):
        runs.add(line_keys(spark.createDataFrame([(k, "x" * 40), (k + 10, "y" * 41)], "doc_id long, text string")))
    first, *rest = runs.runs()
    own = runs.entries([first])
    fresh = own.join(runs.entries(rest).select("h").hint("merge"), "h", "left_anti")
    known = own.join(runs.state().withColumnRenamed("n_docs", "n_").hint("merge"), "h")
    for plan in (runs.state(), fresh, known):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Bucketed: true" in text
    runs.close()


def test_clashing_columns_stay(spark):
    d = spark.createDataFrame([(k, "x" * 50, 1, 2, 3, 4) for k in range(6)], "doc_id long, text string, drop_ int, drop_id_ int, `of` int, dropped int")
    got = dedup_lines(d)
    assert got.columns == [*d.columns, "kept_text", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["n_dropped"], r["drop_"], r["drop_id_"], r["of"], r["dropped"]) for r in got.collect()) == [(k, int(k < 5), 1, 2, 3, 4) for k in range(6)]


def test_texts_meet_their_dropped_keys_by_a_merge_at_any_size(spark):
    """A broadcast of the dropped keys at small sizes hid the shuffle of the texts that larger ones need."""
    d = spark.createDataFrame([(k, "x" * 50) for k in range(6)], "doc_id long, text string")
    got = dedup_lines(d)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
