"""Small tables and plain Python counterparts of the operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns that documents may bring along, named like what operators work with.
EXTRA = {c: "x" for c in ("size", "key", "bucket", "target", "whole", "cls", "n", "columns", "label", "batch", "score", "rank", "line", "page")}


def documents(spark, rows, extra=True):
    """(doc_id, text, source) rows as a documents table, with other columns of any name."""
    more = EXTRA if extra else {}
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in more)
    data = [(i, t, "en", s, None if t is None else len(t), *more.values()) for i, t, s in rows]
    return spark.createDataFrame(data, schema)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = WORD.findall(lowered(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def groups(rows):
    """Smallest id reachable by links, from (id, text) rows, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    top = list(range(len(sets)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= 75 * len(x | y):
                one, other = find(a), find(b)
                top[max(one, other)] = min(one, other)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return {(i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


def prose(seed, n):
    """n words that no other seed has."""
    return " ".join(f"w{(seed * 7919 + k * 104729) % 1000003}" for k in range(n))


def edited(text, every, mark):
    """Every so many words replaced."""
    return " ".join(f"{mark}{k}" if k % every == every - 1 else w for k, w in enumerate(text.split()))


def equals_sql(spark, name, sf_dir="/root/testdata/sf0.001"):
    """Whether a registered query gives the rows of its SQL on the same tables."""
    import duckdb

    from pluvio.llm.registry import ORACLE, QUERIES

    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    expected = con.execute(f"select {', '.join(found.columns)} from ({ORACLE[name]})").fetchall()
    con.close()
    return sorted(map(str, expected)) == sorted(str(tuple(r)) for r in found.collect())
