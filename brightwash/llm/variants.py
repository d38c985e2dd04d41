"""Spelling variants: words one edit apart, found by a frontier in a trie.

The trie is a table of nodes with the labels of their edges. A search state is
(entry, position, node, edits). Level by level all states are joined with the
nodes of that depth: a state without an edit follows the edge of its own
letter, and spends its edit on every other edge; a state that has spent it
follows its own letter only. States that end on a word's last node with
exactly one edit are neighbours. Every join is between distributed tables;
nodes that many states share are met by broadcast (``join_one``).

To bound the depth by ``BLOCK`` however long words are, and to keep searches out
of one common root, a word is entered once for each of its blocks of ``BLOCK``
letters: the root stands for everything before and after the block, the block
is the path below it. The edit between two neighbours lies in one block, so
they share that root. One search replaces a letter (roots of equal length), the
other inserts one: there the searching word's block is a letter shorter and its
rest starts a letter earlier. A deletion is an insertion seen from the other
word. Node names are 64-bit hashes; a collision can only add states, and every
pair is verified by its edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_one, small_batches, written

BLOCK = 3
LETTERS = "A-Za-zÀ-ÿ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def damaged_words(docs: DataFrame, modulus: int = 97) -> DataFrame:
    """Column ``word``: the lower-cased letter runs of all texts, of which those
    whose h = crc32(``doc_id:run``) is a multiple of ``modulus`` lack their letter
    number h modulo their length. A null text has no runs, a null id is empty."""
    runs = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"([{LETTERS}]+)"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % modulus == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the words of enough code points and occurrences."""
    long = words.filter(F.char_length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _entries(words: DataFrame) -> DataFrame:
    """(id, grows, root, block): each word's blocks under their roots. An entry
    with ``grows`` looks for a block one letter longer."""

    def entry(grows: bool) -> Column:
        size = BLOCK - grows

        def at(b: Column) -> Column:
            block = F.substring("word", b * BLOCK + 1, F.lit(size))
            before, after = F.substring("word", F.lit(1), b * BLOCK), F.substring("word", b * BLOCK + size + 1, F.col("length"))
            root = F.xxhash64(b, before, after, F.char_length(block) + int(grows))
            return F.struct(F.lit(grows).alias("grows"), root.alias("root"), block.alias("block"))

        return F.transform(F.sequence(F.lit(0), (F.col("length") / BLOCK).cast("int")), at)

    rows = words.withColumn("length", F.char_length("word"))
    rows = rows.select("id", F.inline(F.concat(entry(False), entry(True))))
    return rows.filter("grows OR block <> ''")


def _child(node: str | Column, letter: Column) -> Column:
    return F.xxhash64(node, letter)


def _trie(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (depth, node, labels) and last nodes (node, near_id) of the words."""
    rows = entries.filter(~F.col("grows"))
    path, node = [], F.col("root")
    last = node
    for depth in range(BLOCK):
        letter = F.substring("block", depth + 1, 1)
        there = F.char_length("block") > depth
        path.append(F.when(there, F.struct(F.lit(depth).alias("depth"), node.alias("node"), letter.alias("letter"))))
        node = _child(node, letter)
        last = F.when(there, node).otherwise(last)
    edges = rows.select(F.explode(F.filter(F.array(*path), lambda e: e.isNotNull())).alias("e")).select("e.*")
    # at most one label for each letter of the alphabet
    nodes = edges.groupBy("depth", "node").agg(F.collect_set("letter").alias("labels"))
    ends = rows.select(last.alias("node"), F.col("id").alias("near_id"))
    return written(nodes, "trie", partition_by="depth"), written(ends, "ends")


def _step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """The states one level deeper."""
    met = join_one(states, nodes, ["node"])
    letter = F.substring("block", F.col("pos") + F.lit(1), F.lit(1))
    ways = met.select("id", "grows", "block", "node", "pos", "edits", letter.alias("letter"), F.explode("labels").alias("label"))
    own, free = F.col("label") == F.col("letter"), F.col("edits") == 0
    # along a label: without an edit (0) if it is the own letter, with one (1) if
    # none is spent; an inserted letter may be the own one as well
    edit = F.explode(
        F.when(own & free & F.col("grows"), F.array(F.lit(0), F.lit(1)))
        .when(own, F.array(F.lit(0)))
        .when(free, F.array(F.lit(1)))
        .otherwise(F.array().cast("array<int>"))
    )
    moved = ways.select("id", "grows", "block", "node", "pos", "edits", "label", edit.alias("edit"))
    stays = F.col("grows") & (F.col("edit") == 1)  # an inserted letter leaves the position where it is
    return moved.select(
        "id",
        "grows",
        "block",
        _child("node", F.col("label")).alias("node"),
        F.when(stays, F.col("pos")).otherwise(F.col("pos") + 1).alias("pos"),
        (F.col("edits") + F.col("edit")).alias("edits"),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near_id), both directions, of all pairs of ``words`` (id, word: each
    distinct) that differ by exactly one inserted, deleted or replaced code point."""
    entries = written(_entries(words), "entries")
    nodes, ends = _trie(entries)
    states = entries.select("id", "grows", "block", F.col("root").alias("node"), F.lit(0).alias("pos"), F.lit(0).alias("edits"))
    found = None
    for depth in range(BLOCK):
        level = nodes.filter(F.col("depth") == depth).select("node", "labels")
        states = written(_step(states, level), "frontier")
        # roots of different lengths differ, so only a last node has the name of one
        done = states.filter((F.col("edits") == 1) & (F.col("pos") == F.char_length("block"))).select("id", "grows", "node")
        found = done if found is None else found.unionByName(done)
    hits = join_one(written(found, "reached"), ends, ["node"]).filter("id <> near_id")
    grown = hits.filter("grows").select(F.col("near_id").alias("id"), F.col("id").alias("near_id"))
    return hits.select("id", "near_id").unionByName(grown).distinct()


def variant_groups(words: DataFrame, least_ratio: float = 2.0) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n).

    ``n_near`` counts the words one edit away; ``form`` is the one of them with
    the largest n (ties: the smallest word in code-point order) if that is at
    least ``least_ratio`` times the word's own, else null; ``root`` is the word
    reached by following forms to the last (the word itself without a form).

    Rows with a null word or n, and further rows of a word, are errors of the
    caller; other columns are not read; an empty vocabulary gives no rows.
    """
    small_batches(words.sparkSession)
    words = written(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = written(neighbours(words.select("id", "word")), "pairs")
    own = words.select("id", "word", "n")
    near = words.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # a word has few neighbours (its length times the letters), so no key is hot
    rows = pairs.join(near, "near_id").join(own, "id").filter(F.levenshtein("word", "near", 1) == 1)
    best = rows.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near", "near_id", "near_n")).alias("best"))
    rows = own.join(best, "id", "left")
    is_form = F.col("best.near_n") >= least_ratio * F.col("n")
    rows = rows.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(is_form, F.col(f"best.{c}")).alias(name) for c, name in (("near", "form"), ("near_id", "form_id"), ("near_n", "form_n"))],
    )
    rows = written(rows, "forms")
    roots = _roots(rows.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id")))
    root = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = written(rows.join(roots, "id", "left").withColumn("root_id", F.coalesce("root_id", "id")), "rooted")
    return join_one(named, root, ["root_id"]).select("word", "n", "n_near", "form", "form_n", "root")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id): each word's last form. The followed distance doubles in
    every round; counts at least grow along a chain, so there are few rounds."""
    now = written(forms, "roots")
    while True:
        after = now.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        moved = join_one(now, after, ["root_id"])
        moved = written(moved.select("id", F.col("next").alias("root_id")), "moved")
        if moved.isEmpty():
            return now
        rest = now.join(moved.select("id"), "id", "left_anti")
        now = written(rest.unionByName(moved), "roots")


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """The variant groups of the words of ``docs`` (``doc_id``, ``text``; other
    columns are not read): see ``damaged_words`` and ``variant_groups``. Nulls:
    a null text has no words, a null id counts as empty; repeated rows count
    each; an empty table gives no rows."""
    return variant_groups(vocabulary(damaged_words(docs), min_length, min_count))
