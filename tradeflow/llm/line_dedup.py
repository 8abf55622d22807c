"""Operator 9: line deduplication by a segment-partition edit-distance join.

Native: DataFrame functions only. Lines within ``edits`` edits of each other
share one of the ``edits + 1`` segments into which the shorter one is cut, at a
place shifted by a few characters at most. Distinct lines are indexed by
(length, segment number, segment) and probed with the substrings that can match
for each length; candidate pairs with alike letter counts are verified by a
banded bit-parallel edit distance. For lines of ``NEAR_WORDS`` words or more the bound grows with the
line: one word edit for every ``WORDS_PER_EDIT`` words (``word_pairs``). Lines of a class (exact or near
copies, transitively) are kept where they stand first: smallest doc_id, then smallest line number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, discard, materialise, table, texts, unboxed
from .components import connected_components

EDITS, MIN_CHARS, NEAR_CHARS = 2, 10, 24
NEAR_WORDS, WORDS_PER_EDIT = 12, 10
GRAM, LONG_WORDS = 5, 40         # words of a gram; from here on equal runs are 8 words long at least, below 6
BROADCAST_IDS = 4 << 20          # line ids (8 bytes each) broadcast at most
CROWD = 32                       # lines of one key that are paired by the key alone
RARE = 3                         # words of the grams that pair the lines of a crowd
LOW = (1 << 20) - 1              # low bits of a word key: where its gram stands and how many keys its line must share
PLACE = (1 << 16) - 1            # the place's bits of these; PLACE if it is not told
ENTRY = ("id", "part", "n", "odd", "key", "pos")       # a line at one of its keys
LANE = (1 << 16) - 1             # most words of a line whose class counts are packed
BLANKS = " \t\r"                   # taken off both ends of a line
LETTER_CLASSES = ("eE", "aA", "tT", "nN", "iI", "oO", "rR", "sS", "hH", "lL", "dD", "uUcC", "bBmMpP", "gGfFwW", " .,", "0123456789")


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_hash, pos, line): trimmed lines of at least ``min_chars`` characters, pos from 0."""
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    out = rows.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("pos", "line"))
    return out.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= min_chars)


def _identity(line: Column | str) -> list[Column]:
    """A line as 128 bits."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def _cut(length: Column, number: int, parts: int) -> Column:
    return F.floor(length * number / parts).cast("int")


def _segment_key(line: str, length: Column, number: int, parts: int, shift: int) -> Column:
    first = _cut(length, number, parts)
    piece = F.substring(line, first + shift + 1, _cut(length, number + 1, parts) - first)
    return F.xxhash64(length, F.lit(number), piece)


def index_keys(edits: int) -> Column:
    """Keys of a line's own segments."""
    return F.array(*[_segment_key("line", F.col("len"), i, edits + 1, 0) for i in range(edits + 1)])


def probe_keys(edits: int) -> Column:
    """Keys of the substrings that a line can share with lines of its length or up to ``edits`` shorter.

    For segment k (from 1) and a length difference d, edits left and right of
    the segment bound its shift to |shift| <= k - 1 and |shift - d| <= edits + 1 - k.
    """
    keys = []
    for d in range(edits + 1):
        for k in range(1, edits + 2):
            low, high = max(1 - k, d - (edits + 1 - k)), min(k - 1, d + edits + 1 - k)
            keys += [_segment_key("line", F.col("len") - d, k - 1, edits + 1, o) for o in range(low, high + 1)]
    return F.array(*keys)


def edit_distance(rows: Column, columns: Column, edits: int) -> Column:
    """Edit distance of two strings, if it is at most ``edits``; else a larger number.

    Both are arrays of characters, which must be columns of a projection below
    (a lambda would split the strings anew for each character). ``columns`` is at most ``edits`` characters longer than ``rows``. Column j of the distance
    matrix is held as one word of vertical differences for rows j - edits .. j + edits; rows above
    the first are virtual ones that match nothing, what lies outside the band counts as larger.
    """
    width = 2 * edits + 1
    full, bottom = (1 << width) - 1, 1 << (width - 1)
    number = lambda v: F.lit(v).cast("long")

    def matches(c: Column, j: Column) -> Column:
        """Bit b: row j - edits + b of the column's band holds the character ``c``."""
        bits = [F.when(F.get(rows, j + (b - edits)) == c, number(1 << b)).otherwise(number(0)) for b in range(width)]
        return sum(bits[1:], bits[0])

    # differences of column 0: -1 down to row 0, +1 from there
    start = F.struct(number(sum(1 << b for b in range(edits + 1, width))).alias("vp"),
                     number(sum(1 << b for b in range(1, edits + 1))).alias("vn"), number(edits).alias("d"))

    def step(s: Column, eq: Column) -> Column:
        # entering the next column the band moves down one row, whose difference is taken as +1
        vp = F.shiftright(s["vp"], 1).bitwiseOR(number(bottom))
        vn = F.shiftright(s["vn"], 1)
        d0 = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn)
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)))
        above = F.shiftleft(hp, 1).bitwiseOR(number(1))
        new_vp = F.shiftleft(vp.bitwiseAND(d0), 1).bitwiseOR(F.bitwise_not(d0.bitwiseOR(above)))
        return F.struct(new_vp.bitwiseAND(number(full)).alias("vp"), d0.bitwiseAND(above).bitwiseAND(number(full)).alias("vn"),
                        (s["d"] + number(1) - F.shiftright(d0, width - 1).bitwiseAND(number(1))).alias("d"))

    def last(s: Column) -> Column:
        # from the band's lowest row up to the last of ``rows``
        below = F.call_function("shiftleft", number(full), F.size(rows) - F.size(columns) + edits + 1)
        return s["d"] - F.bit_count(s["vp"].bitwiseAND(below)) + F.bit_count(s["vn"].bitwiseAND(below))

    return F.aggregate(F.transform(columns, matches), start, step, last)


def without_common_ends(pairs: DataFrame) -> DataFrame:
    """``pairs`` whose character arrays ``short`` and ``long`` lose their common prefix and suffix; the edit distance stays."""
    def equal_run(a: Column, b: Column) -> Column:
        first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
        return F.when(first == 0, F.size(a)).otherwise(F.least(F.size(a), (first - 1).cast("int")))
    out = pairs.withColumn("_head", equal_run(F.col("short"), F.col("long")))
    for name in ("short", "long"):
        out = out.withColumn(name, F.reverse(F.slice(name, F.col("_head") + 1, F.size(name))))
    out = out.withColumn("_tail", equal_run(F.col("short"), F.col("long")))
    for name in ("short", "long"):
        out = out.withColumn(name, F.slice(name, F.col("_tail") + 1, F.size(name)))
    return out.drop("_head", "_tail")


def near_pairs(distinct: DataFrame, edits: int = EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(a, b): ids of different lines of ``distinct`` (id, line, len) within ``edits`` edits."""
    long_enough = distinct.where(F.col("len") >= near_chars)
    index = long_enough.select(F.col("id").alias("a"), F.col("len").alias("la"), F.explode(index_keys(edits)).alias("key"))
    probe = long_enough.select(F.col("id").alias("b"), F.col("len").alias("lb"), F.explode(probe_keys(edits)).alias("key"))
    other = (F.col("la") < F.col("lb")) | ((F.col("la") == F.col("lb")) & (F.col("a") < F.col("b")))
    # first the entries that meet any other line, each once; then pairs, of few lines
    meets = (F.col("i.key") == F.col("p.key")) & other
    i, p = index.alias("i"), probe.alias("p")
    hits = i.join(p, meets, "left_semi").select(F.lit(0).alias("side"), F.col("a").alias("id"), F.col("la").alias("len"), "key").unionByName(
        p.join(i, meets, "left_semi").select(F.lit(1).alias("side"), F.col("b").alias("id"), F.col("lb").alias("len"), "key"))
    hits = materialise(hits.distinct(), "hits")        # one job: both joins share the shuffled sides
    index = hits.where("side = 0").select(F.col("id").alias("a"), F.col("len").alias("la"), "key")
    probe = hits.where("side = 1").select(F.col("id").alias("b"), F.col("len").alias("lb"), "key")
    ids = materialise(hits.select("id").distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS                 # else the same semi join by a shuffle
    wanted = materialise(distinct.join(F.broadcast(ids) if few else ids, "id", "left_semi").select("id", "line"), "lines")
    # an edit changes at most two of the letter counts by one: pairs that differ more are never emitted
    counts = lambda name: wanted.select(F.col("id").alias(name), *[
        (F.octet_length("line") - F.octet_length(F.translate("line", c, ""))).alias(f"{name}{i}") for i, c in enumerate(LETTER_CLASSES)])
    gap = sum((F.abs(F.col(f"a{i}") - F.col(f"b{i}")) for i in range(1, len(LETTER_CLASSES))), F.abs(F.col("a0") - F.col("b0")))
    pairs = index.join(counts("a"), "a").join(probe.join(counts("b"), "b"), "key").where(other & (gap <= 2 * edits))
    pairs = materialise(pairs.select("a", "b").distinct(), "candidates")
    both = (pairs.join(wanted.select(F.col("id").alias("a"), F.col("line").alias("short")), "a")
            .join(wanted.select(F.col("id").alias("b"), F.col("line").alias("long")), "b"))
    both = without_common_ends(both.select("a", "b", F.split("short", "").alias("short"), F.split("long", "").alias("long")))
    # written before the filter, which Spark would else push below the arrays, into the lambdas
    distances = materialise(both.select("a", "b", edit_distance(F.col("short"), F.col("long"), edits).alias("d")), "distances")
    for used in (hits, ids, wanted, pairs):
        discard(used)
    return distances.where(F.col("d") <= edits).select("a", "b")


def _words(line: str) -> Column:
    """The number of words between single blanks."""
    return F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(" "), F.lit(""))) + 1


def _shared(n: Column, run: Column | int, edits: Column) -> Column:
    """Different grams that a line of ``n`` words, no gram twice, shares at least as keys with a line within ``edits`` edits.

    An edit spoils at most as many runs as a run has words, a key stands for as many runs as it is chosen from."""
    return (n - run + 1 - edits * run) / (run - GRAM + 1)


def word_keys(distinct: DataFrame) -> DataFrame:
    """(id, keys) of the lines of ``NEAR_WORDS`` words or more; lines within the bound share the upper bits of a key.

    n words with k = n / 10 edits keep an equal run of (n - k) / (k + 1) words, rounded up: 6 from 12
    words on, 8 from 40 on. A run of t words holds t - 4 grams in a row, and of every so many grams in
    a row the one of smallest hash is a key. Its low bits are the keys that the line shares at least with any line
    within the bound (15 if more) and the gram's number in the line, if no gram of the line occurs twice and the
    line has less than PLACE of them; else they are 1 and PLACE.
    """
    rows = distinct.select("id", "line", _words("line").alias("words"))
    rows = rows.where(F.col("words") >= NEAR_WORDS).select("id", "words", F.transform(F.split("line", " "), lambda w: F.xxhash64(w)).alias("h"))
    clear = F.lit(~LOW)
    gram = lambda i: F.xxhash64(*[F.get("h", i + j if j else i) for j in range(GRAM)]).bitwiseAND(clear)
    rows = rows.select("id", "words", F.transform(F.sequence(F.lit(0), F.size("h") - GRAM), gram).alias("g"))
    k = F.floor(F.col("words") / WORDS_PER_EDIT).cast("int")
    # a line of LONG_WORDS words or more may be the longer one of a pair whose shorter line has less
    least = F.when(F.col("words") < LONG_WORDS, _shared(F.col("words"), 6, k)).when(F.col("words") >= LONG_WORDS + LONG_WORDS // WORDS_PER_EDIT - 1, _shared(F.col("words"), 8, k)).otherwise(1)
    need = F.greatest(F.lit(1), F.least(F.lit(15), F.ceil(least).cast("int")))
    told = (F.size("g") < PLACE) & (F.size(F.array_distinct("g")) == F.size("g"))
    rows = rows.select("id", "words", "g", told.alias("told"))     # read twice below: else Spark would tell anew for each gram
    low = lambda x, i: x.bitwiseOR(F.when(F.col("told"), i).otherwise(PLACE).cast("long"))
    rows = rows.select("id", "words", F.shiftleft(F.when(F.col("told"), need).otherwise(1).cast("long"), 16).alias("need"), F.transform("g", low).alias("g"))

    def smallest(run: int) -> Column:
        width = run - GRAM + 1
        return F.transform(F.sequence(F.lit(0), F.size("g") - width), lambda i: F.least(*[F.get("g", i + j if j else i) for j in range(width)]))
    none = F.array().cast("array<bigint>")
    # a line of up to 42 words may be the longer one of a pair whose shorter line has less than 40
    short = F.when(F.col("words") < LONG_WORDS + LONG_WORDS // WORDS_PER_EDIT - 1, F.array_distinct(smallest(6))).otherwise(none)
    long = F.when(F.col("words") >= LONG_WORDS, F.transform(F.array_distinct(smallest(8)), lambda x: x.bitwiseXOR(clear))).otherwise(none)
    return rows.select("id", F.transform(F.concat(short, long), lambda x: x.bitwiseOR(F.col("need"))).alias("keys"))


def rare_grams(lines: DataFrame) -> DataFrame:
    """(id, gram, pos): grams of RARE words of the lines of ``lines`` (id, n, code) by which those within the bound meet.

    k word edits spoil at most RARE * k grams of either line. So of all grams, in any one order, the first that the
    edits leave in place comes after at most so many others in each of the lines, and stands there among the first
    RARE * k + 1. The order is by the count of lines; of the grams of one line alone, which come first and meet
    nothing, only the number is needed. ``pos`` is where the gram stands, PLACE if a gram occurs twice in the line.
    """
    all_grams = F.transform(F.sequence(F.lit(0), F.col("n") - RARE), lambda i: F.xxhash64(F.substring("code", i * 4 + 1, F.lit(4 * RARE))))
    rows = lines.select("id", "n", all_grams.alias("all")).select("id", "n", F.size("all").alias("places"), F.array_distinct("all").alias("grams"))
    spare = F.size("grams") - RARE * F.floor(F.col("n") / WORDS_PER_EDIT).cast("int") - 1      # the last ones of the order, not needed
    told = (F.size("grams") == F.col("places")) & (F.col("places") < PLACE)
    rows = rows.select("id", spare.alias("spare"), told.alias("told"), F.posexplode_outer("grams").alias("pos", "gram"))
    rows = rows.select("id", "spare", F.when(F.col("told"), F.col("pos")).otherwise(PLACE).alias("pos"), "gram")
    counts = rows.groupBy("gram").agg(F.count("*").alias("lines")).where("lines > 1")
    kept = rows.join(counts, "gram").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("lines", "gram", "pos"))).alias("grams"), F.max("spare").alias("spare"))
    kept = kept.where(F.size("grams") > F.col("spare")).select("id", F.explode_outer(F.slice("grams", F.lit(1), F.least(F.size("grams"), F.size("grams") - F.col("spare")))).alias("g"))
    return materialise(kept.select("id", "g.gram", "g.pos"), "word_rare")


def word_pairs(distinct: DataFrame) -> DataFrame:
    """(a, b): links of different lines of ``distinct`` (id, line) within one word edit for every ``WORDS_PER_EDIT`` words of the shorter.

    Their components are those of all such pairs. First each line is compared with the smallest id of each
    of its keys; then all pairs of a key, but for those that are in one component already. Lines with a key of more
    than CROWD lines (a passage that many lines hold) are paired by their ``rare_grams`` instead, which lines within
    the bound share, and nothing pairs lines in which it stands too far from either end. Lines that share fewer keys
    with all others than they would with any one within the bound are left out first.
    """
    # outer: for explode Spark would push a filter on the size of ``keys`` below the arrays, into the lambdas
    entries = word_keys(distinct).select("id", F.explode_outer("keys").alias("entry"))
    i, p = entries.alias("i"), entries.alias("p")      # the same expressions: one shuffled side serves both
    upper = lambda c: F.col(c).bitwiseAND(F.lit(~LOW))
    hits = i.join(p, (upper("i.entry") == upper("p.entry")) & (F.col("i.id") != F.col("p.id")), "left_semi")
    hits = materialise(hits.select("id", upper("entry").alias("key"), F.col("entry").bitwiseAND(F.lit(LOW)).cast("int").alias("low")), "word_all")
    needs = F.max(F.shiftright("low", 16))
    ids = materialise(hits.groupBy("id").agg(F.count("*").alias("shared"), needs.alias("need")).where("shared >= need").select("id"), "word_ids")
    few = ids.count() <= BROADCAST_IDS
    known = F.broadcast(ids) if few else ids
    every, hits = hits, materialise(hits.join(known, "id", "left_semi").select("id", "key", F.col("low").bitwiseAND(F.lit(PLACE)).alias("pos")), "word_hits")
    discard(every)
    wanted = distinct.join(known, "id", "left_semi").select("id", F.split("line", " ").alias("words"))
    wanted = wanted.select("id", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    # a word as one character of four bytes, and as one of 16 classes
    digits = F.transform("h", lambda h: F.concat(F.lit("F"), F.pmod(h, F.lit(5)).cast("string"),
                                                 F.lpad(F.hex(F.shiftrightunsigned(h, 40)), 6, "0")))
    # one bit for each of 64 classes: whether it has an odd number of the words
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    odd = F.aggregate("h", F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(bit(h)))
    wanted = wanted.select("id", "n", odd.alias("odd"), digits.alias("digits"))
    classes = F.transform("digits", lambda d: F.substring(d, 8, 1))
    wanted = wanted.select("id", "n", "odd", F.unhex(F.array_join("digits", "")).alias("code"), F.array_join(classes, "").alias("bag"))
    # the counts of four classes in one number; of a line of more words none, and no pair of it is ruled out by them
    lanes = lambda four: F.when(F.col("n") <= LANE, sum(
        (F.shiftleft((F.col("n") - F.octet_length(F.replace("bag", F.lit(c), F.lit("")))).cast("long"), 16 * j) for j, c in enumerate(four)), F.lit(0).cast("long")))
    wanted = wanted.select("id", "n", "odd", "code", *[lanes(four).alias(f"c{k}") for k, four in enumerate(("0123", "4567", "89AB", "CDEF"))])
    wanted = materialise(wanted, "word_lines")
    counts = lambda name: wanted.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), *[F.col(f"c{k}").alias(f"{name}{k}") for k in range(4)])
    edits = F.floor(F.least("na", "nb") / WORDS_PER_EDIT).cast("int")
    # a word edit changes at most two of the class counts by one: pairs that differ more are never emitted
    lane = lambda c, j: F.shiftrightunsigned(c, 16 * j).bitwiseAND(F.lit(LANE))
    gap = sum((F.abs(lane(f"a{k}", j) - lane(f"b{k}", j)) for k in range(4) for j in range(4)), F.lit(0).cast("long"))
    alike = (F.abs(F.col("nb") - F.col("na")) <= edits) & F.coalesce(gap <= 2 * edits, F.lit(True))

    def verified(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(wanted.select(F.col("id").alias("a"), F.col("code").alias("one")), "a")
                .join(wanted.select(F.col("id").alias("b"), F.col("code").alias("two")), "b"))
        # at most ``edits``, else -1
        distance = F.call_function("levenshtein", F.col("one").cast("string"), F.col("two").cast("string"), F.col("edits"))
        return both.where(distance >= 0).select("a", "b")
    hubs = hits.groupBy("key").agg(F.min("id").alias("a"))
    star = hits.join(hubs, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    star = star.join(counts("a"), "a").join(counts("b"), "b").where(alike).select("a", "b", edits.alias("edits"))
    star = materialise(star, "word_star")
    links = materialise(verified(star), "word_links")
    discard(star)
    named = wanted.select("id", "n", "odd").join(connected_components(links), F.col("id") == F.col("node"), "left").select(
        "id", "n", "odd", F.coalesce("component", "id").alias("part"))
    placed = materialise(hits.join(named, "id").select(*ENTRY), "word_parts")
    discard(hits)
    groups = placed.groupBy("key").agg(F.count("*").alias("lines"), (F.min("part") < F.max("part")).alias("open"))
    placed, whole = materialise(placed.join(groups.where("open"), "key").select(*ENTRY, "lines"), "word_open"), placed
    discard(whole)
    few, many = placed.where(F.col("lines") <= CROWD), placed.where(F.col("lines") > CROWD)
    crowd_ids = materialise(many.select("id").distinct(), "word_crowd_ids")
    rare = rare_grams(wanted.join(crowd_ids, "id", "left_semi").select("id", "n", "code"))
    # narrow rows tell which grams are met again, in another component: few entries are left for the join
    crowd = rare.join(named, "id").select("id", "part", "n", "odd", F.col("gram").alias("key"), "pos")
    again = crowd.groupBy("key").agg((F.min("part") < F.max("part")).alias("open")).where("open")
    classes = [f"c{k}" for k in range(4)]
    crowd = materialise(crowd.join(again, "key").join(wanted.select("id", *classes), "id").select(*ENTRY, *classes), "word_crowd")
    # of a pair the longer line has less than 1.11 times the words: lengths meet in their own step or in the one above
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.11)))
    run = F.when(F.col("na") < LONG_WORDS, 6).otherwise(8)
    need = [F.when(F.col(f"pos{x}") < PLACE, _shared(F.col(f"n{x}"), run, edits)).otherwise(1) for x in "ab"]
    # the equal run that gives a key has as many words before it and after it, but for the edits there
    before = F.col("posa") - F.col("posb")
    moved = F.when((F.col("posa") < PLACE) & (F.col("posb") < PLACE), F.abs(before) + F.abs(F.col("na") - F.col("nb") - before)).otherwise(0)

    def met(first: DataFrame, second: DataFrame, on: str) -> DataFrame:
        counted = [c for c in classes if c in first.columns]
        sides = [rows.select(*[F.col(c).alias(f"{c}{x}") for c in ENTRY if c != "key"], *[F.col(c).alias(x + c[1:]) for c in counted], *dict.fromkeys(("key", on)))
                 for rows, x in ((first, "a"), (second, "b"))]
        if on != "key":
            sides[1] = sides[1].drop("key")
        ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ida") < F.col("idb")))
        pairs = sides[0].join(sides[1], on).where(ordered & (F.col("parta") != F.col("partb")) & (F.col("nb") - F.col("na") <= edits)
                                              & (moved <= edits) & (F.bit_count(F.col("odda").bitwiseXOR(F.col("oddb"))) <= 2 * edits))
        pairs = pairs.where(alike) if counted else pairs
        return pairs.select(F.col("ida").alias("a"), F.col("idb").alias("b"), F.greatest(*need).alias("need"), "key")
    own, other = F.xxhash64("key", step), F.xxhash64("key", step - 1)
    crowded = met(crowd.withColumn("meet", own), crowd.withColumn("meet", F.explode(F.array(own, other))), "meet").select("a", "b")
    pairs = met(few, few, "key").groupBy("a", "b").agg(F.count_distinct("key").alias("shared"), F.max("need").alias("need")).where(F.col("shared") >= F.col("need"))
    pairs = pairs.select("a", "b").unionByName(crowded).distinct()
    pairs = materialise(pairs, "word_pairs")
    candidates = pairs.join(counts("a"), "a").join(counts("b"), "b").where(alike).select("a", "b", edits.alias("edits"))
    candidates = materialise(candidates, "word_candidates")
    more = materialise(verified(candidates), "word_more")
    for used in (ids, wanted, placed, crowd_ids, rare, crowd, pairs, candidates):
        discard(used)
    return links.unionByName(more)


def all_pairs(distinct: DataFrame, edits: int = EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(a, b): ids of different lines of ``distinct`` (id, line, len) that are near copies by characters or by words."""
    # an edit of a character is two of words at most: from so many words on the word bound takes in the other
    few = distinct.where(_words("line") < 2 * edits * WORDS_PER_EDIT + edits)
    return near_pairs(few, edits, near_chars).unionByName(word_pairs(distinct))


def repeats(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(doc_id, text_hash, pos, first_doc, near): the line occurrences to remove.

    A class of lines is removed everywhere but at its first place: in document
    ``first_doc``, at the smallest line number. ``near`` tells lines whose text
    differs from every line of the class in that document. Lines shorter than
    ``min_chars`` are never removed (two or three words meet by chance, a copy
    proves nothing), those shorter than ``near_chars`` only as exact copies. Equal rows of ``docs`` count as one document. NULL ids come
    last among ids. NULL and empty texts have no line to remove; texts and lines of any length are read whole; an empty table gives no
    rows. Only doc_id and text are read, so other columns may have any name.
    """
    docs = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    found = lines(docs, min_chars)
    distinct = found.groupBy("line").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    distinct = materialise(distinct.select("*", F.char_length("line").alias("len"), F.monotonically_increasing_id().alias("id")), "distinct")
    classes = connected_components(all_pairs(distinct, edits, near_chars))
    named = distinct.join(classes, F.col("id") == F.col("node"), "left")
    # a line of one occurrence and without a near copy needs no further look
    named = named.where((F.col("n") > 1) | F.col("component").isNotNull()).select(
        *_identity("line"), "first", F.coalesce("component", "id").alias("class"))
    named = materialise(named, "classes")
    firsts = named.groupBy("class").agg(F.min("first").alias("first_doc"))
    seen = (found.select("doc_id", "text_hash", "pos", *_identity("line")).distinct()
            .join(named.join(firsts, "class").select("h1", "h2", "class", "first", "first_doc"), ["h1", "h2"]))
    seen = materialise(seen.select("doc_id", "text_hash", "pos", "class", "first_doc", (F.col("first") > F.col("first_doc")).alias("near")), "seen")
    # of several documents of one id the one of smallest text_hash is first
    place = F.struct("text_hash", "pos")
    kept = seen.where(F.col("doc_id") == F.col("first_doc")).groupBy("class").agg(F.min(place).alias("p"))
    kept = kept.select("class", F.col("p.text_hash").alias("kept_hash"), F.col("p.pos").alias("kept_pos"))
    out = seen.join(kept, "class").where((F.col("doc_id") != F.col("first_doc")) | (F.col("text_hash") != F.col("kept_hash")) | (F.col("pos") != F.col("kept_pos")))
    whole = lambda c: F.when(F.col(c) < (1 << 63) - 1, F.col(c)).alias(c)
    return out.select(whole("doc_id"), "text_hash", "pos", whole("first_doc"), "near")


def line_report(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_near, first_docs), one row per document; first_docs: sorted ids that keep its removed lines."""
    gone = repeats(docs, edits, min_chars, near_chars).groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_removed"), F.count_if("near").alias("n_near"), F.sort_array(F.collect_set("first_doc")).alias("first_docs"))
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    key = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_hash"] == gone["text_hash"])
    return rows.join(gone, key, "left").select(
        rows["doc_id"], "n_lines", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs"))


def drop_repeats(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, all columns kept; n_chars, if there, follows.

    Documents without a repeated line stay byte for byte. A document that loses
    every line of at least ``min_chars`` characters (a copy of others) and holds
    nothing else but blanks goes.
    """
    # removed line numbers as masks of 32 lines each: membership without a search per line
    masks = repeats(docs, edits, min_chars, near_chars).groupBy("doc_id", "text_hash", F.floor(F.col("pos") / 32).cast("int").alias("part")).agg(
        F.sum(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % 32)).alias("mask"))
    masks = masks.groupBy("doc_id", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("part", "mask"))).alias("_masks"),
                                                     F.sum(F.bit_count("mask")).alias("_gone"))
    masks = masks.select(F.col("doc_id").alias("_mask_id"), F.col("text_hash").alias("_mask_hash"), "_masks", "_gone")
    rows = boxed(docs).join(masks, F.col("_id").eqNullSafe(F.col("_mask_id")) & (F.col("_hash") == F.col("_mask_hash")), "left")
    solid = F.size(F.filter(F.split("_row.text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    rows = rows.where(F.col("_gone").isNull() | (solid > F.col("_gone"))).withColumn("_lines", F.split("_row.text", "\n"))
    rows = rows.withColumn("_parts", F.transform(F.sequence(F.lit(0), F.floor(F.size("_lines") / 32).cast("int")),
                                                 lambda p: F.coalesce(F.try_element_at("_masks", p), F.lit(0).cast("long"))))
    kept = F.filter("_lines", lambda x, i: F.getbit(F.get("_parts", F.floor(i / 32).cast("int")), i % 32) == 0)
    cut = F.col("_masks").isNotNull()
    out, changed = rows.withColumn("_text", F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("_row.text"))), {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.char_length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return unboxed(out, docs.columns, **changed)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))
