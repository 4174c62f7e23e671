"""Line dedup (operator 1): a segment-partition edit join over distinct lines.

Lines of at least ``MIN_CHARS`` characters within ``EDITS`` edits of each other
are linked; classes are the connected components. The first line of a class
(smallest doc_id, then line number) stays, all others are removed.

1. Equal lines become one, with their first place. With ``exact_chars`` this covers
   shorter lines too, down to that length: equal ones are a class; blank lines stay.
2. Each distinct line is split into EDITS + 1 segments. Two lines within EDITS
   edits share a segment exactly: the longer one holds it as a substring, at a
   place that the lengths narrow to a few positions (multi-match-aware
   windows). Segments are the index rows, those substrings the probes; the key
   is (length, segment number, text), hashed.
3. Pairs under a key are verified by a banded bit-parallel edit distance: the
   vertical differences of the 2 * EDITS + 1 cells around the diagonal are bits of one
   number, moved along the text by a fold over characters. The equal
   beginnings and ends (but for a few characters) are left out; as both ends of
   the rest take an edit, a pair passes only if a piece between them is unchanged.
4. Keys with many lines do not make all pairs: in each round the next few lines
   of a key, some times as many as before, are paired with its other lines that
   they are not connected to yet and whose length and letter counts are near
   enough. Keys whose lines are all connected leave. So no link between classes
   is lost.

All on DataFrame functions; nothing but distinct lines and 16-byte key rows is
shuffled. Removed line numbers are joined back to the documents by a broadcast
of at most ``BROADCAST_ROWS`` documents' lists, else by a shuffle.

Defined cases: null text stays null and has no lines; an empty text is one
empty line; lines shorter than ``exact_chars`` are never removed; a text's order of kept lines stays;
rows with equal doc_id are one document (equal lines at equal numbers stay or
go together); documents without doc_id lose nothing and make no others lose;
other columns pass through, those named like the outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.llm.common import components, read_table, staged

EDITS = 2
MIN_CHARS = 32     # of lines compared by edits
EXACT_CHARS = 1    # of lines whose exact repeats go, in the query and the pipeline
FIRST_LEADS = 64   # lines of a key that meet all others in the first round, and the growth per round
BROADCAST_ROWS = 1_000_000   # line ids, or lists of line numbers, some 100 MB
# Letters counted together: similar lines have similar counts (any partition will do).
BAGS = ("eE", "aA", "iI", "oO", "nN", "tT", "rR", "sS", "lLhH", "dDcC", "uUyY", "mMgG", "wWbBpPfF", "0123456789", " ", ".,")


def _lines(docs: DataFrame, doc_id: str, text: str, exact_chars: int | None = None) -> DataFrame:
    long = F.length("line") >= MIN_CHARS
    if exact_chars is not None:
        long = long | ((F.length("line") >= exact_chars) & F.col("line").rlike(r"\S"))
    return (docs.where(F.col(doc_id).isNotNull())
            .select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))
            .where(long))


def _keys(lines: DataFrame, edits: int) -> DataFrame:
    """Rows (key, id, index) of lines (id, n, line): index rows for a line's own segments, probes for lines up to ``edits`` shorter.

    A line is first repeated for every (length difference, segment, shift), so
    that one short expression makes all keys.
    """
    k = edits + 1
    cases = [(d, i, shift) for d in range(edits + 1) for i in range(1, k + 1)
             for shift in range(max(1 - i, d - (k - i)), min(i - 1, d + (k - i)) + 1)]
    rows = lines.select("id", "n", "line", F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in zip(("d", "i", "shift"), case)]) for case in cases])))
    # segment i of a text of n - d characters: all of the same size, the last ones a character longer
    start = F.expr(f"(i - 1) * ((n - d) div {k}) + greatest(0, i - 1 - {k} + (n - d) % {k}) + 1 + shift").cast("int")
    size = F.expr(f"(n - d) div {k} + if(i > {k} - (n - d) % {k}, 1, 0)").cast("int")
    rows = rows.withColumns({"start": start, "size": size}).where("start >= 1 and start + size <= n + 1")
    return rows.select("id", F.xxhash64(F.expr("n - d"), "i", F.substring("line", F.col("start"), F.col("size"))).alias("key"),
                       F.expr("d = 0 and shift = 0").alias("index"))


def _shared_start(a: str, b: str) -> str:
    """SQL for the number of characters at which two texts begin alike, by binary search."""
    return (f"aggregate(transform(sequence(20, 0, -1), k -> shiftleft(1, k)), 0, (p, step) -> "
            f"if(p + step <= least(length({a}), length({b})) and left({a}, p + step) = left({b}, p + step), p + step, p))")


def edit_distance_at_most(df: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """Rows of ``df`` whose texts ``a`` and ``b`` are within ``edits`` edits; lines of more than 2 ** 21 characters compare whole."""
    width = 2 * edits + 1
    mask, top = (1 << width) - 1, 1 << (2 * edits)
    begin = ((1 << (edits + 1)) - 1) << edits
    keep = edits + 1
    def bound(rows: DataFrame, short: str, long: str) -> DataFrame:
        # a generator binds the values: as plain columns they would be computed anew wherever the fold names them
        return rows.select(*df.columns, F.inline(F.array(F.struct(F.expr(short).alias("__s"), F.expr(long).alias("__l")))))

    def rest(c: str) -> str:   # what follows the shared beginning, but for edits + 1 characters, turned round
        return f"reverse(substring({c}, greatest({_shared_start('__s', '__l')} - {keep}, 0) + 1))"

    rows = df.where(F.abs(F.length(a) - F.length(b)) <= edits)
    rows = bound(rows, f"if(length(`{a}`) <= length(`{b}`), `{a}`, `{b}`)", f"if(length(`{a}`) <= length(`{b}`), `{b}`, `{a}`)")
    rows = bound(rows, rest("__s"), rest("__l"))
    rows = bound(rows, rest("__s"), rest("__l"))
    # both ends of what is left take an edit, so one of edits - 1 pieces of the part between them occurs unchanged
    k, inner = max(1, edits - 1), f"greatest(length(__s) - {2 * (keep + edits)}, 0)"
    rows = rows.where(" or ".join(
        f"instr(__l, substring(__s, {keep + edits + 1} + {inner} * {i} div {k}, {inner} * {i + 1} div {k} - {inner} * {i} div {k})) > 0"
        for i in range(k)))
    rows = bound(rows, "split(__s, '')", "split(__l, '')")
    match = " + ".join(f"if(get(__s, j - 1 - {edits} + {t}) = get(__l, j - 1), {1 << t}L, 0L)" for t in range(width))
    step = f"""
      transform(array({match}), pm ->
      transform(array(((((pm & s.vp) + s.vp) ^ s.vp) | pm | s.vn) & {mask}L), d0 ->
      transform(array(named_struct('hp', (s.vn | ~(d0 | s.vp)) & {mask}L, 'hn', d0 & s.vp)), h ->
        named_struct(
          'vp', (h.hn | ~(shiftright(d0, 1) | h.hp)) & {mask}L,
          'vn', shiftright(d0, 1) & h.hp,
          'dist', s.dist + if(j <= size(__s) - {edits}, if((d0 & {top}L) = 0, 1, 0),
              if((shiftright(h.hp, size(__s) - j + {edits}) & 1L) = 1, 1, 0)
              - if((shiftright(h.hn, size(__s) - j + {edits}) & 1L) = 1, 1, 0))))[0])[0])[0]"""
    distance = F.expr(f"""aggregate(sequence(1, size(__l)), named_struct('vp', {begin}L, 'vn', 0L, 'dist', {edits}),
                          (s, j) -> {step}, s -> s.dist)""")
    return rows.where(distance <= edits).select(*df.columns)


def _similar(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """Those pairs (a, b) of line ids that are within ``edits`` edits."""
    texts = lines.select("id", "line")
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b"))
    return staged(edit_distance_at_most(both, "line_a", "line_b", edits).select("a", "b"), "similar")


def line_links(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Links (a, b) between distinct lines (id, n, line) that make the same components as all pairs within ``edits`` edits."""
    # one exchange by key: rows whose key has an index row and a second line
    same = Window.partitionBy("key")
    keyed = _keys(lines, edits).withColumns({
        "x": F.min("id").over(same), "y": F.max("id").over(same), "any": F.max("index").over(same)}).where("x != y and any")
    now = staged(keyed.groupBy("key", "id").agg(F.max("index").alias("index")), "shared")
    ids = staged(now.select("id").distinct(), "ids")
    some = staged(lines.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "id")
                  .withColumns({f"bag{i}": _count_of("line", b) for i, b in enumerate(BAGS)}), "some")
    bags = [f"bag{i}" for i in range(len(BAGS))]
    order = Window.partitionBy("key").orderBy(F.desc("index"), "id")
    now = now.withColumn("place", F.row_number().over(order).cast("bigint") - 1).join(some.select("id", "n", *bags), "id")
    now = staged(now, "keys").withColumn("component", F.col("id"))
    # an edit changes the lengths by one and the counts of letters by two at most
    near = " + ".join(f"abs({c} - lead_{c})" for c in bags) + f" <= {2 * edits} and abs(n - lead_n) <= {edits}"
    links = tested = None
    low, high = 0, FIRST_LEADS
    while True:
        leads = now.where(F.col("index") & F.col("place").between(low, high - 1)).select(
            "key", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("place").alias("pa"),
            *[F.col(c).alias(f"lead_{c}") for c in ("n", *bags)])
        pairs = (leads.join(now.withColumnRenamed("key", "lead_key"), F.expr(f"key = lead_key and place > pa and component != ca and {near}"))
                 .select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        found = _similar(pairs, some, edits)
        links, tested = (found, pairs) if links is None else (links.union(found), tested.union(pairs))
        low, high = high, FIRST_LEADS * high
        now = now.drop("component").join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                       F.max(F.when(F.col("index"), F.col("place"))).alias("last")).where(
            (F.col("x") != F.col("y")) & (F.col("last") >= low)).select("key")
        now = staged(now.join(mixed, "key", "left_semi"), "keys")
        if now.isEmpty():
            return links


def _count_of(column: str, letters: str) -> Column:
    return F.length(column) - F.length(F.translate(column, letters, ""))


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS, exact_chars: int | None = None) -> DataFrame:
    """doc_id, removed: the line numbers to remove, with the line's hash and whether the kept line differs."""
    lines = _lines(docs, doc_id, text, exact_chars)
    distinct = lines.groupBy("line").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n"))
    distinct = staged(distinct.withColumnRenamed("n", "times").withColumns(
        {"id": F.monotonically_increasing_id(), "n": F.length("line")}), "lines")
    known = components(line_links(distinct.where(F.col("n") >= MIN_CHARS).select("id", "n", "line"), edits))
    # lines that occur again or are linked; others are alone in their class
    some = (distinct.join(known, "id", "left").where("times > 1 or component is not null")
            .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "first",
                    F.coalesce("component", "id").alias("component")))
    kept = some.groupBy("component").agg(F.min("first").alias("kept"))
    some = some.join(kept, "component").select("h1", "h2", "kept", (F.col("first") != F.col("kept")).alias("near"))
    places = lines.select("doc_id", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    gone = places.join(some, ["h1", "h2"]).where(F.struct("doc_id", "line_no") != F.col("kept"))
    return staged(gone.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "h1", "near")).alias("removed")), "removed")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS, exact_chars: int | None = None) -> DataFrame:
    """``docs`` with deduped (the text of the lines that stay), n_lines, n_removed and n_near (removed ones that differ from the kept line).

    Exact repeats of lines from ``exact_chars`` characters on go as well (if not given: from ``MIN_CHARS``).
    """
    outputs = ("deduped", "n_lines", "n_removed", "n_near")
    gone = removed_lines(docs, doc_id, text, edits, exact_chars).withColumnRenamed("doc_id", "__id")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    rows = docs.join(gone, F.col(doc_id) == F.col("__id"), "left").drop("__id")
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(
        x.alias("line"), F.filter("removed", lambda r: (r["line_no"] == i) & (r["h1"] == F.xxhash64(x))).alias("hit")))
    whole = F.col("removed").isNull()
    rows = rows.withColumn("__lines", F.when(~whole, lines))
    rows = rows.withColumns({
        "deduped": F.when(whole, F.col(text)).otherwise(F.array_join(F.transform(
            F.filter("__lines", lambda x: F.size(x["hit"]) == 0), lambda x: x["line"]), "\n")),
        "n_lines": F.coalesce(F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint"),
        "n_removed": F.when(whole, 0).otherwise(F.size(F.filter("__lines", lambda x: F.size(x["hit"]) > 0))).cast("bigint"),
        "n_near": F.when(whole, 0).otherwise(F.size(F.filter("__lines", lambda x: F.exists(x["hit"], lambda r: r["near"])))).cast("bigint")})
    return rows.select(*[c for c in docs.columns if c not in outputs], *outputs)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines removed from all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, exact_chars=EXACT_CHARS).select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("deduped", F.lit("")), 256).alias("kept_sha256"))
