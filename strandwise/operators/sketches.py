"""K-mer sets of sequences: sketches, distances, screens, classification and clustering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.reads import kmers
from strandwise.operators.scan import dealt, running
from strandwise.operators.taxonomy import fold_to_common
from strandwise.storage import discard, stored


def canonical(word: Column) -> Column:
    """The lesser of a word and its reverse complement."""
    return F.least(word, F.reverse(F.translate(word, "ACGT", "TGCA")))


def portable_hash(word: Column) -> Column:
    """A hash that other engines have too: 60 bits of MD5."""
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, 15), 16, 10).cast("long")


def words(df: DataFrame, k: int, key: str = "seq_id", split: str | None = None, canonical_words: bool = False) -> DataFrame:
    """(key, word): distinct k-mers of seq, or k-grams of what split cuts."""
    if split is None:
        found = kmers(F.col("seq"), k)
        return df.select(key, F.explode(F.array_distinct(F.transform(found, canonical) if canonical_words else found)).alias("word"))
    # the exploded one-item array keeps the parts from being cut again for each word
    cut = df.select(key, F.explode(F.array(F.filter(F.split("seq", split), lambda p: p != ""))).alias("_p"))
    found = F.transform(F.when(F.size("_p") >= k, F.sequence(F.lit(1), F.size("_p") - k + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.array_join(F.slice("_p", i, k), " "))
    return cut.select(key, F.explode(F.array_distinct(found)).alias("word"))


def sketch(of: DataFrame, size: int, key: str = "seq_id") -> DataFrame:
    """(key, h): the size least hashes of the words of each key. Ranked before equal hashes are made one, so each task cuts its
    own rows down to so many a key before the shuffle."""
    hashed = of.select(key, portable_hash(F.col("word")).alias("h"))
    return hashed.withColumn("_n", F.dense_rank().over(Window.partitionBy(key).orderBy("h"))).filter(F.col("_n") <= size).select(key, "h").distinct()


def shared_counts(sketches: DataFrame, key: str = "seq_id") -> DataFrame:
    """(a, b, shared), a > b: pairs that share hashes. Pairs are met through shared hashes only; a hash of many keys makes
    many pairs, so words that are common to most sequences belong in a screen, not here."""
    a, b = sketches.select(F.col(key).alias("a"), "h"), sketches.select(F.col(key).alias("b"), "h")
    return a.join(b, "h").filter("a > b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def mash_distances(sketches: DataFrame, k: int, key: str = "seq_id") -> DataFrame:
    """(a, b, jaccard, distance) of pairs that share a hash; all others have distance 1. distance = -ln(2j / (1 + j)) / k."""
    sizes = sketches.groupBy(key).agg(F.count("*").alias("n"))
    pairs = shared_counts(sketches, key).join(sizes.select(F.col(key).alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col(key).alias("b"), F.col("n").alias("nb")), "b")
    j = F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
    return pairs.select("a", "b", j.alias("jaccard")).withColumn("distance", F.greatest(F.lit(0.0), -F.log(2 * F.col("jaccard") / (1 + F.col("jaccard"))) / k))


def sketch_classes(sketches: DataFrame, key: str = "seq_id") -> tuple[DataFrame, DataFrame]:
    """((a representative a class: key, sketch array), (key, representative)) of sketches (key, h): keys of one and the same
    sketch are a class, and its least key stands for it, so thousands of copies are compared once. Both stored."""
    whole = stored(sketches.groupBy(key).agg(F.array_sort(F.collect_set("h")).alias("sketch")))
    classes = stored(whole.groupBy("sketch").agg(F.min(key).alias("representative")))
    return classes.select(F.col("representative").alias(key), "sketch"), whole.join(classes, "sketch").select(key, "representative")


def block_pairs(classes: DataFrame, k: int, key: str = "seq_id", block: int = 512) -> DataFrame:
    """(a, b, shared, jaccard, distance), a > b, of all pairs of classes (key, sketch array) that share a hash; all others have
    distance 1. distance = -ln(2j / (1 + j)) / k.

    The keys of a hash are dealt into blocks of about block keys, and a row goes to each pair of blocks that its own is part
    of, so a task meets two blocks at a time, whatever share of the keys a hash has. A pair counts only at the least hash that
    it shares, where its sketches are compared whole: it comes once, and its shared hashes are never listed."""
    posted = classes.select(F.col(key).alias("k"), F.size("sketch").alias("size"), F.explode("sketch").alias("h"))
    sizes = posted.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    common = stored(posted.join(sizes.select("h", "blocks"), "h"))
    # of a sketch only the hashes that others have too go along
    parts = common.groupBy("k").agg(F.array_sort(F.collect_list("h")).alias("sketch"))
    placed = common.join(parts, "k").withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("h", "own", "k", "size", "sketch", others)
    # a pair of blocks is one key of the join; within a block both sides hold all of it
    low, high = dealt.filter("own <= other"), dealt.filter("own >= other")
    left = low.select("h", F.col("own").alias("lo"), F.col("other").alias("hi"), F.col("k").alias("x"), F.col("size").alias("nx"), F.col("sketch").alias("sx"))
    right = high.select("h", F.col("other").alias("lo"), F.col("own").alias("hi"), F.col("k").alias("y"), F.col("size").alias("ny"), F.col("sketch").alias("sy"))
    met = left.join(right, ["h", "lo", "hi"]).filter("(lo < hi or x < y) and x <> y")
    both = met.select("h", F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"), F.array_intersect("sx", "sy").alias("both"), (F.col("nx") + F.col("ny")).alias("n"))
    shared = both.filter(F.array_min("both") == F.col("h")).select("a", "b", F.size("both").cast("long").alias("shared"), "n")
    j = F.col("shared") / (F.col("n") - F.col("shared"))
    return shared.select("a", "b", "shared", j.alias("jaccard")).withColumn("distance", F.greatest(F.lit(0.0), -F.log(2 * F.col("jaccard") / (1 + F.col("jaccard"))) / k))


def screen(reads: DataFrame, references: DataFrame, k: int, key: str = "ref") -> DataFrame:
    """(key, shared, total, identity, multiplicity): reference sketches (key, h) against the hashes of all reads (h)."""
    seen = reads.groupBy("h").agg(F.count("*").alias("times"))
    total = references.groupBy(key).agg(F.count("*").alias("total"))
    found = references.join(seen, "h").groupBy(key).agg(F.count("*").alias("shared"), F.median("times").alias("multiplicity"))
    return total.join(found, key, "left").withColumn("shared", F.coalesce("shared", F.lit(0))).select(key, "shared", "total", F.pow(F.col("shared") / F.col("total"), F.lit(1.0 / k)).alias("identity"), "multiplicity")


def contaminated(of: DataFrame, contaminants: DataFrame, least: int = 1, key: str = "seq_id") -> DataFrame:
    """(key, shared): keys of words that share at least so many words with the contaminants (word)."""
    return of.join(contaminants.select("word").distinct(), "word", "left_semi").groupBy(key).agg(F.count("*").alias("shared")).filter(F.col("shared") >= least)


def classify_words(of: DataFrame, taxa: DataFrame, closure: DataFrame, key: str = "seq_id") -> DataFrame:
    """(key, taxid, score): words (key, word) against (word, taxid); of the taxa hit, the one whose path to the root holds the
    most hits, ties to the deeper, then the lesser taxid."""
    hits = of.join(taxa, "word").groupBy(key, "taxid").agg(F.count("*").alias("hits"))
    path = closure.select(F.col("taxid").alias("leaf"), F.col("ancestor").alias("taxid"), "depth")
    depth = closure.groupBy("taxid").agg(F.max("depth").alias("level")).withColumnRenamed("taxid", "leaf")
    scored = hits.select(key, F.col("taxid").alias("leaf")).join(path, "leaf").join(hits, [key, "taxid"]).groupBy(key, "leaf").agg(F.sum("hits").alias("score")).join(depth, "leaf")
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.desc("level"), "leaf")
    return scored.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(key, F.col("leaf").alias("taxid"), "score")


def word_taxa(found: DataFrame, closure: DataFrame) -> DataFrame:
    """(word, taxid) from rows (word, taxid) of taxa that hold words: a word of several taxa belongs to their deepest common
    ancestor; words of taxa without one, or outside the closure, are left out."""
    return fold_to_common(found, closure, "word").filter("taxid is not null")


def classify_reads(reads: DataFrame, taxa: DataFrame, closure: DataFrame, key: str = "seq_id") -> DataFrame:
    """(key, taxid, score, hits): words (key, word) against word_taxa(). The hits of a key make a tree; the path from the root
    with the most hits decides: a taxon's score is the hits at it and at all above it. The taxon at the path's end is the
    answer, the deepest common ancestor of the ends where paths tie. hits: all words of the key with a taxon. Keys without
    any are left out. A hit outside the closure counts for no path, so taxa come from word_taxa()."""
    found = reads.select(key, "word").join(taxa, "word").groupBy(key, "taxid").agg(F.count("*").alias("n"))
    above = closure.select("taxid", "ancestor")
    on_path = found.select(key, F.col("taxid").alias("ancestor"), F.col("n").alias("_above"))
    scored = found.join(above, "taxid").join(on_path, [key, "ancestor"]).groupBy(key, "taxid").agg(F.sum("_above").alias("score"))
    best = scored.groupBy(key).agg(F.max("score").alias("score"))
    ends = scored.join(best, [key, "score"])
    total = found.groupBy(key).agg(F.sum("n").alias("hits"))
    return fold_to_common(ends, closure, key).join(best, key).join(total, key).select(key, "taxid", "score", "hits")


def without_host(reads: DataFrame, classified: DataFrame, key: str = "seq_id") -> DataFrame:
    return reads.join(classified.select(key).distinct(), key, "left_anti")


def cluster_sequences(of: DataFrame, lengths: DataFrame, share: float = 0.85, minima: int = 8, key: str = "seq_id", rounds: int = 100, block: int = 1024) -> DataFrame:
    """(key, centroid): greedy by length: sequences meet in buckets of their least word hashes, where each is compared with
    the bucket's longest. The longest sequences are centres; one that holds the share of its words in a centre joins the
    longest such, and can't be a centre itself; one whose candidates all joined others is a centre.
    Candidates are as many as sequences and buckets, and every round decides those whose longer candidates are decided."""
    low = sketch(of, minima, key).join(lengths, key)
    longest = low.groupBy("h").agg(F.min_by(F.struct(F.col(key).alias("centre"), F.col("length").alias("centre_length")), F.struct(-F.col("length"), key)).alias("c")).select("h", "c.*")
    pairs = stored(low.join(longest, "h").filter(F.col("centre") != F.col(key)).select(key, "centre", "centre_length").distinct())
    # a set is one row; a centre of many goes to as many tasks as its candidates need
    parts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / block).cast("int").alias("_parts"))
    asked = pairs.select(F.col(key).alias("_k")).union(pairs.select("centre")).distinct()
    few = asked.count() <= 1 << 20
    hashed = of.select(F.col(key).alias("_k"), portable_hash(F.col("word")).alias("h"))
    hashed = hashed.join(F.broadcast(asked), "_k", "left_semi") if few else hashed
    sets = hashed.groupBy("_k").agg(F.collect_set("h").alias("_words"))
    own = pairs.join(parts, "centre").join(sets.select(F.col("_k").alias(key), F.col("_words").alias("_own")), key).withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int"))
    held = sets.join(parts.withColumnRenamed("centre", "_k"), "_k").select(F.col("_k").alias("centre"), "_words", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    both = own.join(held, ["centre", "_part"]).select(key, "centre", "centre_length", F.size("_own").alias("n"), F.size(F.array_intersect("_own", "_words")).cast("long").alias("shared"))
    near = stored(both.filter(F.col("shared") >= share * F.col("n")).drop("n"))
    left, member = near, near.limit(0)
    for _ in range(rounds):
        open_keys = left.select(F.col(key).alias("centre")).distinct()
        joins = stored(left.join(open_keys, "centre", "left_anti").select(*near.columns))  # their candidate is a centre
        if joins.isEmpty():
            break
        member = member.unionAll(joins)
        joined = joins.select(key).distinct()
        left = stored(left.join(joined, key, "left_anti").join(joined.withColumnRenamed(key, "centre"), "centre", "left_anti").select(*near.columns))
    else:
        raise RuntimeError("clusters did not settle")
    chosen = member.groupBy(key).agg(F.max_by("centre", F.struct("centre_length", "shared", "centre")).alias("centroid"))
    return lengths.select(key).join(chosen, key, "left").select(key, F.coalesce("centroid", key).alias("centroid"))


def greedy_clusters(of: DataFrame, lengths: DataFrame, share: float = 0.85, key: str = "seq_id", first: int = 8, rounds: int = 40) -> DataFrame:
    """(key, centroid) of sequences (key, length) and their distinct words (key, word): in order of falling length, ties by key,
    a sequence joins the first centre before it that holds at least that share of its words, else it is a centre. Sequences
    without words are centres.

    Exact candidates by a prefix filter: if a share of a sequence's words lies in another, one of its rarest words does too,
    of as many as may be missing and one more; so only those are looked up among the words of all. Sequences of equal words
    are one class, which its first stands for. A word's holders are ranked in order (by ranges, so a common word is no one
    task's), and looked up first ranks first: a round compares what is undecided with the next ranks, four times as many as
    the round before, without holders that have joined a centre. So of thousands of near copies each meets the longest, not
    all others. At the end what isn't a centre is compared with centres only, and joins the first.
    """
    sets = stored(of.select(F.col(key).alias("k"), F.xxhash64("word").alias("h")).groupBy("k").agg(F.array_sort(F.collect_set("h")).alias("w")))
    sized = stored(lengths.select(F.col(key).alias("k"), "length").join(sets, "k").select("k", "length", F.size("w").cast("long").alias("n"), F.xxhash64("w").alias("x"), F.xxhash64(F.lit(1), "w").alias("y")))
    place = F.struct((-F.col("length")).alias("l"), F.col("k"))
    classes = stored(sized.groupBy("n", "x", "y").agg(F.min(place).alias("p")).select("n", "x", "y", F.col("p.k").alias("rep"), F.col("p.l").alias("l")))
    words_of = sets.join(classes.select(F.col("rep").alias("k"), "l", "n"), "k").select("k", "l", "n", F.explode("w").alias("h"))
    # a word of one class only links nothing: it counts in n, and goes no further
    common = stored(words_of.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1"))
    held = stored(words_of.join(common, "h"))
    discard(sets, common)
    ranges = dealt(held, ["h"], ["l", "k"])
    ranked = stored(running(ranges, ["h"], ["l", "k"], {"rank": ("sum", F.lit(1).cast("long"))}).drop("_range"))
    discard(ranges)
    of_key = Window.partitionBy("k")
    rare = ranked.withColumn("_i", F.row_number().over(of_key.orderBy("f", "h"))).withColumn("_s", F.count("*").over(of_key))
    asked = stored(rare.filter(F.col("_i") <= F.col("_s") - F.ceil(share * F.col("n")) + 1).filter("rank > 1").select("h", "k", "n", "rank"))
    arrays = stored(held.groupBy("k").agg(F.collect_list("h").alias("w")))
    discard(held)
    holders = ranked.select("h", F.col("k").alias("c"), F.col("rank").alias("r"), F.col("n").alias("m"), F.col("l").alias("cl"))

    def contained(pairs: DataFrame) -> DataFrame:
        """(k, c, cl) of the pairs (k, c, cl, n) where c holds the share of k's n words."""
        side = lambda name: arrays.select(F.col("k").alias(name), F.col("w").alias(f"w{name}"))
        both = pairs.join(side("k"), "k").join(side("c"), "c")
        return both.filter(F.size(F.array_intersect("wk", "wc")) >= share * F.col("n")).select("k", "c", "cl")

    depth = asked.groupBy("k").agg((F.max("rank") - 1).alias("depth"))
    state = stored(classes.select(F.col("rep").alias("k")).join(depth, "k", "left").select("k", F.coalesce("depth", F.lit(0)).alias("depth"), F.lit(None).cast("boolean").alias("centre")))
    edges, below, upto = None, 0, first
    for _ in range(rounds):
        undecided = state.filter("centre is null").select("k")
        if undecided.isEmpty():
            break
        near = holders.filter(f"r > {below} and r <= {upto}").join(state.filter("not centre").select(F.col("k").alias("c")), "c", "left_anti")
        met = asked.filter(f"rank > {below + 1}").join(undecided, "k", "left_semi").join(near, "h").filter((F.col("r") < F.col("rank")) & (F.col("m") >= share * F.col("n")))
        found = contained(met.select("k", "c", "cl", "n").dropDuplicates(["k", "c"])).select("k", "c")
        before, edges = edges, stored(found if edges is None else found.unionAll(edges))
        if before is not None:
            discard(before)
        while True:  # hand decisions along the edges: holders of a sequence come before it, so they are decided before it
            joined = edges.join(state.filter("centre").select(F.col("k").alias("c")), "c", "left_semi").select("k").distinct()
            waits = edges.join(state.filter("not centre").select(F.col("k").alias("c")), "c", "left_anti").select("k").distinct()
            marked = state.join(joined.withColumn("_joined", F.lit(True)), "k", "left").join(waits.withColumn("_waits", F.lit(True)), "k", "left")
            now = F.when(F.col("_joined"), False).when(F.col("_waits").isNull() & (F.col("depth") <= upto), True)
            after = stored(marked.select("k", "depth", F.coalesce("centre", now).alias("centre"), (F.col("centre").isNull() & now.isNotNull()).alias("_new")))
            done = after.filter("_new").isEmpty()
            before, state = state, after.drop("_new")
            discard(before)
            if done:
                break
        below, upto = upto, 4 * upto
    else:
        raise RuntimeError("clusters did not settle")
    centres = state.filter("centre").select(F.col("k").alias("c"))
    others = asked.join(state.filter("not centre").select("k"), "k", "left_semi")
    met = others.join(holders.join(centres, "c", "left_semi"), "h").filter((F.col("r") < F.col("rank")) & (F.col("m") >= share * F.col("n")))
    chosen = contained(met.select("k", "c", "cl", "n").dropDuplicates(["k", "c"])).groupBy("k").agg(F.min(F.struct("cl", "c"))["c"].alias("c"))
    of_class = classes.join(chosen.withColumnRenamed("k", "rep"), "rep", "left").select("n", "x", "y", F.coalesce("c", "rep").alias("c"))
    clustered = stored(sized.join(of_class, ["n", "x", "y"]).select(F.col("k").alias(key), F.col("c").alias("centroid")))
    return lengths.select(key).join(clustered, key, "left").select(key, F.coalesce("centroid", key).alias("centroid"))
