"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of words; in scripts written without spaces every
character counts as a word. Each distinct line is written once with its
earliest place; a line emits the hashes of itself and of every variant with
one word deleted; equal hashes meet in a join, the word edit distance of the
pair is verified, and the line that occurs first stays.

The join stays linear in a group of copies:

* a word replaced at place p leaves both lines with the same variant "without
  word p" (and the same length), and all lines that share this variant are
  within one edit of each other. The earliest line of the group stands for
  them all, so each member is paired with it alone.
* a word inserted makes one variant of the longer line equal to the shorter
  line; a variant has at most one distinct line that it can equal.

Two lines within one edit share their first or last ``min_words // 2`` words,
and also the first or second half of their words, so a line that shares neither with
another distinct line emits no variants.

A line goes if an earlier line of the corpus is equal or within one edit,
whether or not that one goes too; the first of a family always stays. Earlier
means the smaller doc_id (NULL last), then the smaller text hash, then the
smaller line number. Only DataFrame operations.

With ``short``, exact copies go whatever the length of the line, and only the
variants need ``min_words`` words (one word more or less says nothing about two
short lines). Without it, lines under ``min_words`` words stay.

Defined cases: blank lines stay; a NULL text stays NULL; a document whose every line went, words
and all, is dropped, and one that had no words before stays; rows with equal doc_id
and text are treated alike; an empty table gives an empty result; helper
columns take names that the input does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.llm.common import SPACE_CHARS, SPACE_CLASS, staged, words

MIN_WORDS = 8
#: Characters of scripts that put no spaces between words (Thai, Lao, Tibetan, Myanmar, Khmer, Han, kana).
UNSPACED = (r"[฀-࿿က-႟ក-៿⺀-⿟々-〇〡-〩〱-ヿㇰ-ㇿ"
            r"㐀-䶿一-鿿豈-﫿ｦ-ﾟ\x{20000}-\x{3ffff}]")


def within_one_edit(a: str, b: str) -> str:
    """SQL condition: the word arrays ``a`` and ``b`` differ by at most one
    replaced, inserted or deleted word."""
    def inserted(long: str, short: str) -> str:
        # the first place where they differ is where the longer one has the extra word
        at = (f"array_position(zip_with(slice({long}, 1, size({short})), {short}, (x, y) -> x <> y), true)")
        return (f"case when {at} = 0 then true else "
                f"slice({long}, cast({at} + 1 as int), size({long})) = slice({short}, cast({at} as int), size({short})) end")
    return (f"case when size({a}) = size({b}) then size(filter(zip_with({a}, {b}, (x, y) -> x <> y), v -> v)) <= 1 "
            f"when size({a}) = size({b}) + 1 then {inserted(a, b)} "
            f"when size({b}) = size({a}) + 1 then {inserted(b, a)} else false end")


def _text_lines(text: str = "text") -> str:
    """SQL: the lines of a text, with spaces around the characters that are words of their own."""
    # such characters take three bytes or more: texts without any need no search for them
    return (rf"split(case when octet_length({text}) > length({text}) + 1 and {text} rlike r'[^\x00-\x{{7ff}}]' and {text} rlike r'{UNSPACED}' "
            rf"then regexp_replace({text}, r'({UNSPACED})', ' $1 ') else {text} end, '\n', -1)")


def _joined(line: str) -> Column:
    """The words of a line joined by one space each; most lines already are that, but for spaces around them."""
    c = F.col(line)
    odd = [F.contains(c, F.lit(x)) for x in ("  ", "\t", "\x0b", "\x0c", "\r")]
    return F.when(odd[0] | odd[1] | odd[2] | odd[3] | odd[4], F.array_join(words(c), " ")).otherwise(F.trim(c))


def _lines(docs: DataFrame, *carry: str, where: str = "true") -> DataFrame:
    """(carry, no, l, n): the lines that have words, as words joined by a space, and how many words."""
    # an outer explode, as an inner one would be preceded by a filter that splits every text once more
    rows = docs.select(*carry, F.expr(f"posexplode_outer({_text_lines()}) as (no, line)")).where(where)
    # blank lines are told by the line itself: a filter on l would have the words made once more for itself
    rows = rows.where(F.ltrim(F.col("line"), F.lit(SPACE_CHARS)) != "").select(*carry, "no", _joined("line").alias("l"))
    return rows.selectExpr(*carry, "no", "l", "octet_length(l) - octet_length(replace(l, ' ', '')) + 1 as n")


def _hashes() -> list[Column]:
    return [F.expr("xxhash64(l) as h1"), F.expr("xxhash64(1, l) as h2")]


def _halves() -> list[Column]:
    """Keys of which two lines within one edit share one: if the shorter has m words, either
    the first m // 2 words or the last m - m // 2 words are the same in both."""
    keys = []
    for m in ("n", "(n - 1)"):
        for side, cut in (("first", f"{m} div 2"), ("last", f"{m} div 2 - {m}")):
            keys.append(F.expr(f"xxhash64('{side}', {m}, substring_index(l, ' ', cast({cut} as int)))"))
    return keys


PLACE = "struct(id is null as u, id, th, no)"


def find_copies(docs: DataFrame, min_words: int = MIN_WORDS, short: bool = False) -> DataFrame:
    """(id, th, gone): per document the numbers of its lines that go.

    ``docs`` has id, th and text.
    """
    ends = min_words // 2
    # lines too short for variants have no ends
    end = lambda side, k: F.expr(f"case when n >= {min_words} then xxhash64('{side}', substring_index(l, ' ', {k})) end")
    places = _lines(docs, "id", "th")
    occ = staged((places if short else places.where(f"n >= {min_words}")).select(
        "id", "th", "no", *_hashes(), end("first", ends).alias("k1"), end("last", -ends).alias("k2")), "line-places")

    # distinct lines, each with its earliest place
    line = staged(occ.groupBy("h1", "h2").agg(F.min(F.expr(PLACE)).alias("place"), F.count("*").alias("n"),
                                              F.first("k1").alias("k1"), F.first("k2").alias("k2")), "lines")

    # lines that share an end with another line, and their words
    ends_of = line.where("k1 is not null").select("h1", "h2", F.explode(F.array("k1", "k2")).alias("k"))
    shared = staged(ends_of.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "line-ends")
    alike = staged(ends_of.join(shared, "k", "left_semi").select("h1", "h2").distinct(), "lines-alike")
    at = staged(line.select("h1", "h2", "place").join(alike, ["h1", "h2"], "left_semi")
                .selectExpr("place.id as id", "place.th as th", "place.no as no")
                .groupBy("id", "th").agg(F.collect_set("no").alias("nos")), "lines-at")
    # texts are always joined by sorting, at every size alike: what they meet grows with the corpus
    holders = (docs.alias("d").hint("merge").join(at.alias("a"), F.expr("d.id <=> a.id and d.th = a.th"))
               .select("d.id", "d.th", "text", "nos"))
    texts = staged(_lines(holders, "id", "th", "nos", where="array_contains(nos, no)")
                   .select(F.expr(PLACE).alias("place"), *_hashes(), "l", "n").dropDuplicates(["h1", "h2"]), "line-ended")

    # of those, the lines that share half of their words with a line of the same length or one word off
    half = staged(texts.select("h1", "h2", F.posexplode(F.array(*_halves())).alias("side", "k")), "line-halves")
    shared = staged(half.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "line-half-keys")
    alike = staged(half.join(shared, "k", "left_semi").groupBy("h1", "h2").agg(
        F.max(F.expr("side % 2 = 0")).alias("first"), F.max(F.expr("side % 2 = 1")).alias("last")), "lines-half-alike")
    # from here on a line is its number, which grows with its place
    texts = staged(texts.join(alike, ["h1", "h2"]).orderBy("place").drop("place")
                   .withColumn("seq", F.monotonically_increasing_id()), "line-texts")

    # the deletion neighbourhood: the line without word p, for all p at which a line that
    # shares the first (last) half can differ; the line itself is added below
    start = "case when last then 1 else (n - 1) div 2 + 1 end"
    stop = "case when first then n else n div 2 + 1 end"
    without = ("case when p = 1 then substring_index(l, ' ', 1 - n) when p = n then substring_index(l, ' ', n - 1) "
               "else concat(substring_index(l, ' ', p - 1), ' ', substring_index(l, ' ', p - n)) end")
    variants = staged(
        texts.selectExpr("seq", "n", "l", f"explode(sequence(cast({start} as int), cast({stop} as int))) as p")
        .selectExpr("seq", "n", "p", f"xxhash64({without}) as key"), "line-variants")
    leads = staged(variants.groupBy("key", "n", "p").agg(F.min("seq").alias("lead"), F.count("*").alias("c"))
                   .where("c > 1").drop("c"), "line-leads")
    replaced = variants.join(leads, ["key", "n", "p"]).where("lead < seq").select("seq", "lead")
    whole = texts.selectExpr("h1 as key", "seq as other", "n as size")
    inserted = (variants.join(whole, "key").where("size = n - 1")
                .selectExpr("greatest(seq, other) as seq", "least(seq, other) as lead"))
    pairs = replaced.union(inserted).distinct()

    # verify, then mark the later line
    own = texts.select("seq", "h1", "h2", F.split("l", " ").alias("a"))
    lead = texts.select(F.col("seq").alias("lead"), F.split("l", " ").alias("b"))
    near = staged(pairs.join(own, "seq").join(lead, "lead").where(F.expr(within_one_edit("a", "b")))
                  .select("h1", "h2").distinct(), "lines-near")

    known = staged(line.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
                   .where("n > 1 or near").selectExpr("h1", "h2", "place", "coalesce(near, false) as near"), "lines-copied")
    gone = (occ.select("id", "th", "no", "h1", "h2").join(known, ["h1", "h2"])
            .where(F.col("near") | (F.expr(PLACE) != F.col("place"))))
    return staged(gone.groupBy("id", "th").agg(F.collect_set("no").alias("gone")), "lines-gone")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               counts: bool = False, short: bool = False) -> DataFrame:
    """``docs`` with copied lines removed from the text; documents left without words go.

    ``short`` removes exact copies of lines under ``min_words`` words as well.
    ``counts`` adds n_lines and n_removed and keeps the emptied documents.
    """
    if min_words < 2:
        raise ValueError("min_words must be at least 2")
    th = F.xxhash64(F.col(f"`{text_col}`"))
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), th.alias("th"), F.col(f"`{text_col}`").alias("text"))
    gone = find_copies(ids, min_words, short)
    d = docs.alias("d").hint("merge").join(gone.alias("g"), F.expr(
        f"d.`{id_col}` <=> g.id and xxhash64(d.`{text_col}`) = g.th"), "left")
    kept = F.expr(f"case when g.gone is null then d.`{text_col}` else array_join(filter("
                  rf"split(d.`{text_col}`, '\n', -1), (l, i) -> not array_contains(g.gone, i)), '\n') end")
    out = [kept.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns]
    if counts:
        lines = F.expr(rf"cast(coalesce(size(split(d.`{text_col}`, '\n', -1)), 0) as bigint)")
        out = [o for o, c in zip(out, docs.columns) if c.lower() not in ("n_lines", "n_removed")]
        return d.select(*out, lines.alias("n_lines"),
                        F.coalesce(F.size("g.gone"), F.lit(0)).cast("long").alias("n_removed"))
    return d.where(F.col("g.gone").isNull() | kept.rlike(f"[^{SPACE_CLASS[1:-1]}]")).select(*out)
