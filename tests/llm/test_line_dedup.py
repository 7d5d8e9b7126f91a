import duckdb

from saletrace.llm import line_dedup


def naive(rows, min_words):
    """Lines to remove: (id, line, start, end, first id), rows in rank order."""
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        at = 0
        for n, line in enumerate((t or "").split("\n")):
            words = line.lower()
            for c in "\t\r\x0b\x0c":
                words = words.replace(c, " ")
            words = tuple(w for w in words.split(" ") if w)
            if len(words) >= min_words:
                if words in seen:
                    out.append((i, n, at, at + len(line), seen[words]))
                seen.setdefault(words, i)
            at += len(line) + 1
    return out


def rows_of(prose):
    shared = [prose(n, 50 + n) for n in (3, 6, 30, 60)]
    rows = [(k, "\n".join([prose(25, k), shared[k % 4], prose(2, 300 + k), shared[k % 3].upper()
                           if k % 2 else "  " + shared[k % 3].replace(" ", "  \t")]))
            for k in range(40)]
    return rows


def test_equals_brute_force(spark, make_docs, prose, odd_rows, monkeypatch):
    rows = rows_of(prose) + odd_rows + [(None, prose(25, 1)), (39, rows_of(prose)[39][1])]
    docs = make_docs(rows, clash=True)
    for least, hot in ((5, 1_000_000), (5, 8), (20, 1_000_000)):
        monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)  # some digests sliced, or none
        got = line_dedup.repeated_lines(docs, min_words=least).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(naive(rows, least), key=repr)


def test_remove_repeats(spark, make_docs, prose, odd_rows):
    own = [(i + 100, t) for i, t in rows_of(prose)]
    rows = own + odd_rows
    docs = make_docs(rows, clash=True)
    out = line_dedup.remove_repeats(docs, min_words=5)
    assert out.columns == docs.columns and out.count() == len(rows)
    gone = {}
    for i, _, a, b, _ in naive(rows, 5):
        gone.setdefault(i, []).append((a, b))
    texts = {r.doc_id: r.text for r in out.collect()}
    for i, t in own:
        want, at = "", 0
        for a, b in sorted(gone.get(i, [])):
            want, at = want + t[at:a], b + 1
        assert texts[i] == want + t[at:]
    assert texts[1] is None and texts[2] == ""
    assert line_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_equals_sql(spark, sf_small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    got = line_dedup.repeated_lines(spark.read.parquet(f"{sf_small}/documents.parquet"), min_words=8)
    want = con.sql(line_dedup.repeated_lines_sql(min_words=8)).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_short_lines_are_removed_too(spark, sf_small):
    """The query over all lines equals its SQL, and brute force; repeats of
    under 20 words are among its rows."""
    from saletrace.llm import queries
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    got = sorted(map(tuple, queries.QUERIES["op4_all_lines"](spark, sf_small).collect()))
    assert got == sorted(con.sql(queries.ORACLES["op4_all_lines"]).fetchall())
    texts = con.sql("SELECT doc_id, text FROM documents").fetchall()
    assert got == sorted(naive(texts, 1))
    by_id = dict(texts)
    assert any(len(by_id[i][a:b].split()) < 20 for i, _, a, b, _ in got)


def naive_passages(rows, min_words):
    """Spans to remove, from units cut character by character."""
    units = []
    for n, (i, t) in enumerate(rows):
        t, sentences, start, line = t or "", [], 0, 0
        for at, c in enumerate(t):
            ends = c == "\n" or (c in ".!?" and t[at + 1:at + 2] not in (".", "!", "?"))
            if ends or at == len(t) - 1:
                stop = at if c == "\n" else at + 1
                words = tuple(t[start:stop].lower().encode().split())
                if words:
                    sentences.append((line, start, stop, words))
                start, line = at + 1, line + (c == "\n")
        for k in range(len(sentences)):
            words = ()
            for m in range(k, len(sentences)):
                words += sentences[m][3]
                if len(words) >= min_words:
                    units.append((i, n, *sentences[k][:2], sentences[m][2], True, words))
                    break
        at = 0
        for k, body in enumerate(t.split("\n")):
            words = tuple(body.lower().encode().split())
            if len(words) >= min_words:
                units.append((i, n, k, at, at + len(body), False, words))
            at += len(body) + 1
    units.sort(key=lambda u: (u[0] is None, u[0] or 0, u[1], u[3]))
    first, gone = {}, {}
    for i, n, line, a, b, run, words in units:
        key = (run, words)
        if key in first and (not run or first[key][1] != n):
            gone.setdefault(n, []).append((a, -b, (first[key][0] is not None, first[key][0] or 0),
                                           run, line, i, first[key][0]))
        first.setdefault(key, (i, n))
    out = []
    for spans in gone.values():
        reached = -1
        for a, b, _, _, line, i, f in sorted(spans):
            if a < reached:
                out[-1][3] = max(out[-1][3], -b)
            else:
                out.append([i, line, a, -b, f])
            reached = max(reached, -b)
    return sorted(map(tuple, out), key=repr)


def test_passages_equal_brute_force(make_docs, prose, odd_rows, monkeypatch):
    passage = ". ".join(prose(n, 90 + n) for n in (4, 7, 9, 6, 8)) + "! "
    rows = []
    for k in range(30):
        host = prose(30, k).split(" ")
        at = k % 29
        rows.append((k, " ".join(host[:at]) + " " + (passage.upper() if k % 4 == 1 else passage)
                     + " ".join(host[at:]) + (".\nNo. No! No.\n" + prose(25, 500 + k % 5)) * (k % 3)))
    rows += odd_rows
    for least, hot in ((20, 1_000_000), (5, 8)):
        monkeypatch.setattr(line_dedup, "HOT_ROWS", hot)
        got = line_dedup.repeated_passages(make_docs(rows, clash=True), min_words=least).collect()
        assert sorted(map(tuple, got), key=repr) == naive_passages(rows, least)


def test_passages_inside_lines_are_found(make_docs, prose):
    """A passage of 60 words in the middle of a line of each of two texts."""
    passage = " ".join(prose(10, 700 + n) + "." for n in range(6))
    rows = [(k, f"{prose(40, k)} {passage} {prose(40, 50 + k)}") for k in range(2)] + [(2, prose(90, 9))]
    got = line_dedup.repeated_passages(make_docs(rows)).collect()
    assert [(r.doc_id, r.first_id) for r in got] == [(1, 0)]
    assert len(rows[1][1][got[0].start:got[0].end].split()) >= 50


def test_passages_of_an_empty_table(make_docs):
    assert line_dedup.repeated_passages(make_docs([])).collect() == []
