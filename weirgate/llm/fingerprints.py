"""I-Match fingerprints over randomised lexicons.

Terms whose document frequency lies in a band are the lexicon. Besides the full lexicon,
random subsets of falling density are drawn, in chains that each halve the one before; a
text's fingerprint is, for every lexicon, the hash of its sorted distinct terms that lie in
it. Sparse subsets survive edits that dense ones do not, so the share of equal hashes grows
with the likeness of two texts. Only DataFrame functions are used.

A term is its 64-bit hash. The lexicon is measured; up to ``TABLE_TERMS`` it is one broadcast row,
a table of two possible places for each term, so that texts meet it where they are. Beyond,
terms are joined to it by shuffle. Either way gives the same fingerprints.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import filled, following_ids
from weirgate.session import cut_lineage

# Band of document frequencies as shares of all documents. The lexicon is at most the mean
# number of distinct terms of a document divided by the lower share, whatever the corpus.
LOW, HIGH = 0.0005, 0.1
# Chains of subsets of density 1/2, 1/4, ... down to 2 ** -LEVELS.
LEVELS, CHAINS = 10, 6
SUBSETS = 1 + LEVELS * CHAINS
# A lexicon that is broadcast as a table, of 20 bytes a term at most; each text copies it once.
TABLE_TERMS = 1 << 17


def words_of(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def terms_of(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    return F.transform(F.filter(words_of(text), lambda w: w != ""), lambda w: F.xxhash64(w))


def code_of(term: Column) -> Column:
    """40 bits of the term, and for each chain how deep the term lies in it (0 to LEVELS)."""
    drawn = F.xxhash64(term, F.lit(7))
    code = F.shiftleft(term, 4 * CHAINS)
    for chain in range(CHAINS):
        part = F.shiftright(drawn, LEVELS * chain).bitwiseOR(F.lit(1 << LEVELS).cast("long"))
        # Trailing zeros, at most LEVELS.
        depth = F.bit_count(part.bitwiseAND(-part) - 1).cast("long")
        code = code.bitwiseOR(F.shiftleft(depth, 4 * chain))
    return code


def lexicon(df: DataFrame, low: float, high: float) -> DataFrame:
    """(term): hashes of the terms of the band. Only hashes travel, counted before they do."""
    total = df.count()
    counted = df.select(F.explode(terms_of(F.col("_w_text"))).alias("_w_term")).groupBy("_w_term").agg(F.count("*").alias("_w_df"))
    band = counted.where((F.col("_w_df") >= max(2, low * total)) & (F.col("_w_df") <= max(2, high * total)))
    return band.where("_w_term <> 0").select("_w_term")


def _places(terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a term in a table of ``size`` (a power of two)."""
    return terms & (size - 1), (terms >> 32) & (size - 1)


def term_table(terms: list[int]) -> np.ndarray:
    """The high halves of the hashes, each at one of its two places; 0 marks an empty place.

    A place depends on the low half or on the high one, so a term is known by both.
    """
    values = np.array(sorted(terms), dtype=np.int64)
    size = 16
    while size < 2.5 * len(values):
        size *= 2
    while True:
        first, second = (p.tolist() for p in _places(values, size))
        where = {t: (a, b) for t, a, b in zip(values.tolist(), first, second, strict=True)}
        table: dict[int, int] = {}
        for term in where:
            at = where[term][0]
            for _ in range(500):
                term, table[at] = table.get(at), term
                if term is None:
                    break
                # The one that stood here moves to its other place.
                a, b = where[term]
                at = b if at == a else a
            else:
                break
        else:
            out = np.zeros(size, dtype=np.int32)
            for at, term in table.items():
                out[at] = _mark(term)
            return out
        size *= 2


def _mark(term: int) -> int:
    """Bits 32 to 63 as a signed number, and never 0, which marks an empty place."""
    return (term >> 32) or 1


def _in_table(table: str, size: int):
    """Column function: whether a term is in the lexicon, by its two places in the table, an
    array column (its items are read in place)."""
    mask = F.lit(size - 1).cast("long")

    def test(term: Column) -> Column:
        high = F.shiftright(term, 32)
        mark = F.when(high == 0, F.lit(1)).otherwise(high.cast("int"))
        places = (term.bitwiseAND(mask), high.bitwiseAND(mask))
        found = [F.get(F.col(table), p.cast("int")) == mark for p in places]
        return found[0] | found[1]

    return test


def _hashes(codes: Column) -> Column:
    """One hash per lexicon of the sorted codes in it; null where there are none."""
    def hashed(chosen: Column) -> Column:
        return F.when(F.size(chosen) > 0, F.hash(chosen))

    def chain(number: int) -> Column:
        start = F.struct(codes.alias("left"), F.array().cast("array<int>").alias("out"))

        def step(state: Column, level: Column) -> Column:
            deep = F.filter(state["left"], lambda c: F.shiftright(c, 4 * number).bitwiseAND(F.lit(15).cast("long")) >= level)
            return F.struct(deep.alias("left"), F.concat(state["out"], F.array(hashed(state["left"]))).alias("out"))

        # The first hash is that of the whole lexicon, the others of the subsets.
        whole = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS + 1)), start, step, lambda s: s["out"])
        return whole if number == 0 else F.slice(whole, 2, LEVELS)

    return F.concat(*[chain(n) for n in range(CHAINS)])


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes among lexicons that meet either text; 1 for two empty texts."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    met = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() & (p["x"] == p["y"])))
    return F.when(met > 0, same / met).otherwise(F.lit(1.0))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it; the optimizer
    would write the value into each place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _named(codes: Column, terms: Column) -> Column:
    """Hashes of a text; without a term of the band all its terms name it together."""
    alone = F.concat(
        F.array(F.when(F.size(terms) > 0, F.hash(F.array_sort(terms)))),
        F.array_repeat(F.lit(None).cast("int"), SUBSETS - 1),
    )
    return F.when(F.size(codes) > 0, _hashes(codes)).otherwise(alone)


def with_hashes(rows: DataFrame, texts: dict[str, str], band: DataFrame, most: int = TABLE_TERMS) -> DataFrame:
    """Rows with the hashes of each text column in place of it; ``texts``: column to new name.

    ``band`` is the lexicon, pinned. Beyond ``most`` terms it is joined: terms and their row's
    number travel then, and no text.
    """
    if band.count() <= most:
        table = term_table([r[0] for r in band.collect()])
        member = _in_table("_w_table", len(table))
        # One row, of a size known by now.
        carried = rows.sparkSession.createDataFrame([(table.tolist(),)], "_w_table array<int>")

        def named(terms: Column) -> Column:
            codes = F.array_sort(F.transform(F.filter(terms, member), code_of))
            return _let(codes, lambda c: _named(c, terms))

        joined = rows.crossJoin(F.broadcast(carried))
        return joined.withColumns({name: _let(terms_of(F.col(c)), named) for c, name in texts.items()}).drop("_w_table", *texts)
    # Rows are pinned with a number, so that their terms find back to them.
    terms = rows.withColumns({f"_w_t_{name}": terms_of(F.col(c)) for c, name in texts.items()}).drop(*texts)
    terms = cut_lineage(terms.withColumn("_w_row", F.monotonically_increasing_id()))
    coded = terms
    for name in texts.values():
        each = terms.select("_w_row", F.explode(f"_w_t_{name}").alias("_w_term")).join(band, "_w_term")
        lists = each.groupBy("_w_row").agg(F.array_sort(F.collect_list(code_of(F.col("_w_term")))).alias(f"_w_c_{name}"))
        coded = coded.join(lists, "_w_row", "left").withColumn(
            f"_w_c_{name}", F.coalesce(f"_w_c_{name}", F.array().cast("array<bigint>"))
        )
    done = coded.withColumns({name: _named(F.col(f"_w_c_{name}"), F.col(f"_w_t_{name}")) for name in texts.values()})
    return done.drop("_w_row", *[f"_w_{x}_{name}" for x in "tc" for name in texts.values()])


def printed(hashes: str) -> Column:
    """Hashes as one line of text; lexicons that do not meet the text are empty between commas."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), ",", "")


def edited_fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    The edited text has its last third replaced by as many first characters of the next
    document in descending id order (after the last: the first). A null text is empty. Rows
    that repeat stay; where an id repeats, its smallest text stands for it as a next
    document. A row without an id has no next document: its tail is cut and ``near_next``
    is null. Extra columns are not read. An empty table gives an empty table.
    """
    rows = df.select(F.col(f"`{id}`").alias("doc_id"), filled(text).alias("_w_text"))
    band = cut_lineage(lexicon(rows, low, high))
    counted = rows.select("doc_id", F.length("_w_text").cast("long").alias("n_chars"))
    order = cut_lineage(following_ids(counted, "doc_id"))
    longest = counted.groupBy("doc_id").agg(F.max(F.floor(F.col("n_chars") / 3)).alias("_w_tail"))
    # What each document is asked for by the one before it: how much of its head, and by whom.
    asked = order.join(longest, "doc_id").select(
        F.col("next_key").alias("doc_id"), F.col("doc_id").alias("_w_for"), F.col("_w_tail")
    )
    links = asked.join(order.withColumnRenamed("next_key", "_w_next"), "doc_id")
    # Texts are dealt by id once; heads, a third of them, go to the document before.
    placed = rows.join(links, "doc_id", "left")
    # Both uses keep the join as it is, or its exchange of texts would not be shared.
    heads = placed.groupBy(F.coalesce("_w_for", "doc_id").alias("_w_own")).agg(
        F.min(F.expr("substring(_w_text, 1, int(_w_tail))")).alias("_w_head")
    )
    tail = F.floor(F.length("_w_text") / 3)
    edited = F.concat(
        F.expr("substring(_w_text, 1, int(length(_w_text) - floor(length(_w_text) / 3)))"),
        F.substring(F.coalesce("_w_head", F.lit("")), F.lit(1), tail.cast("int")),
    )
    both = placed.join(heads, F.col("doc_id") == F.col("_w_own"), "left").select(
        "doc_id", "_w_next", "_w_text", edited.alias("_w_edited")
    ).select(
        "*",
        F.length("_w_text").cast("long").alias("n_chars"),
        F.sha2(F.col("_w_edited").cast("binary"), 256).alias("edited_sha256"),
        F.xxhash64("_w_text").alias("_w_whole"),
    )
    found = cut_lineage(with_hashes(both, {"_w_text": "_w_hashes0", "_w_edited": "_w_hashes1"}, band))
    following = found.groupBy(F.col("doc_id").alias("_w_next")).agg(
        F.min(F.struct("_w_whole", "_w_hashes0"))["_w_hashes0"].alias("_w_following")
    )
    return found.join(following, "_w_next", "left").select(
        "doc_id", "n_chars", "edited_sha256",
        printed("_w_hashes0").alias("fingerprint"), printed("_w_hashes1").alias("edited_fingerprint"),
        likeness("_w_hashes0", "_w_hashes1").alias("near_edited"),
        F.when(F.col("_w_following").isNotNull(), likeness("_w_hashes0", "_w_following")).alias("near_next"),
    )
