"""Secret scan with a random forest against false positives; DataFrame functions and Spark ML only.

Candidates are long mixed strings, strings with a well-known head, and values assigned to names like
password or token; a word without blanks (compact JSON, a query string) gives all that it holds. A random forest decides on each by its length, the transitions between its kinds of
characters, how much of it dictionary words and syllables cover, whether it looks like a path, and the
words beside it. It is trained on labelled findings: candidates whose label follows from their form
(issued heads, assigned random values; digits only, paths, plain words), each also without its neighbours and,
for true ones, spoiled into placeholders, so that no single sign decides. The sample is bounded by
``MAX_FINDINGS`` labelled rows with the smallest hashes; counting and scoring cover every document.

Everything but the training sample is row-wise: no shuffle, so hot sources or copies do not matter.

Defined cases: null and empty texts have no findings; features and digest see the
whole candidate, however long; repeated rows repeat their findings.
"""

from __future__ import annotations

import random
import string

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.tables import stored

MAX_FINDINGS = 8_000
#: Rounds of made-up rows that any sample is given besides.
KNOWN = 40
TREES, DEPTH, SEED = 20, 6, 11
THRESHOLD = 0.5
#: Longer findings are scored like all others, but not labelled.
LONGEST_LABELLED = 1_000

# Heads that issuers give their keys, names that secrets are assigned to, and words of
# placeholders and ordinary identifiers.
HEADS = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|sk_test_|rk_live_|xox[abprs]-|AIza|ya29\.|eyJ)"
NAMES = r"(?i)(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)"
DICTIONARY = (
    "example sample test dummy fake placeholder changeme your my the some insert here default password secret token key "
    "value user admin root none null true false foo bar abc xyz lorem ipsum version release license public general "
    "http https www com org net html file path name class data index config module object string number "
    "tion ing ation ment eren the and ther con pre pro ver str int"
).split()
_LETTERS = r"[A-Za-z0-9+/_.~-]"
_ASSIGNED = NAMES + r"[\w-]*[\"']?(?:=|:=|:|=>)[\"']?([^\s\"'<>,;]{8,})"
_LONG = _LETTERS + r"{16,}={0,2}"
#: A long run with the name it is given to, if any, and an opening mark.
_SHOWN = r"(?:([\w.-]+)[\"']?(?:=|:=|:|=>))?[\"'`(]?(" + _LONG + ")"
_WORDS = "(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))
FEATURES = (
    "length", "lower", "upper", "digits", "other", "distinct", "transitions", "case_transitions", "digit_transitions", "vowels",
    "longest_letters", "longest_same", "covered", "path", "hex", "head", "assigned", "named_before", "sign_before", "quoted",
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, secret, word, before, sign: every candidate of ``docs`` (doc_id, text).

    A word may hold several; ``word`` is what of it belongs to the candidate.
    """
    # A cheap look at the whole text first; most documents hold no candidate.
    likely = docs.where(F.col("text").rlike(_LONG) | F.col("text").rlike(NAMES))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # Every word beside the two before it; only what may hold a candidate leaves the array, so no word carries the text.
    before = lambda k: F.concat(F.array_repeat(F.lit(""), k), F.col("words"))
    beside = F.transform(
        F.arrays_zip(F.col("words").alias("word"), before(1).alias("one"), before(2).alias("two")),
        lambda x, i: F.struct(i.alias("start_word"), x["word"].alias("word"), x["one"].alias("one"), x["two"].alias("two")),
    )
    may = lambda x: (F.length(x["word"]) >= 8) & (x["word"].rlike(_LONG) | x["word"].rlike(NAMES))
    found = likely.select("doc_id", words.alias("words")).select("doc_id", F.inline(F.filter(beside, may)))
    every = lambda pattern, group: F.regexp_extract_all("piece", F.lit(pattern), F.lit(group))
    assigned = F.arrays_zip(every(_ASSIGNED, 0).alias("word"), every(_ASSIGNED, 1).alias("secret"))
    long_ = F.arrays_zip(every(_SHOWN, 0).alias("word"), every(_SHOWN, 1).alias("name"), every(_SHOWN, 2).alias("secret"))
    none = F.lit("")
    # A long run inside an assigned value is that value, or a part of it.
    own = F.filter(long_, lambda x: ~F.exists(F.col("values"), lambda y: F.contains(y["secret"], x["secret"])))
    both = F.concat(
        F.transform("values", lambda x: F.struct(x["word"].alias("word"), none.alias("name"), x["secret"].alias("secret"))), own
    )
    # The values of a query string are cut apart, as a value may hold other marks.
    pieces = found.select("*", F.col("word").alias("whole"), F.explode(F.split("word", r"&(?=[\w.-]+=)")).alias("piece")).drop("word")
    each = pieces.withColumn("values", assigned).withColumn("c", F.explode(F.array_distinct(both))).where(
        F.length("c.secret") >= 8
    )
    # What stands inside the word is the neighbour of all but its first candidate.
    first = F.startswith("whole", F.col("c.word"))
    named = F.col("c.name") != ""
    return each.select(
        "doc_id", "start_word", "c.secret", "c.word",
        # name = "value" has the name two words before the value, name: value one.
        F.when(named, F.col("c.name")).when(~first, "").when(F.col("one").rlike(r"^(?:=|:|:=|=>)$"), F.col("two")).otherwise(F.col("one")).alias("before"),
        (named | (first & F.col("one").rlike(r"(?:=|:|=>)$"))).alias("sign"),
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("s", F.lit(pattern)) / F.length("s")


def _longest(pattern: str) -> Column:
    runs = F.regexp_extract_all("s", F.lit(pattern), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)) / F.length("s")


def with_features(found: DataFrame) -> DataFrame:
    """Adds the numbers of ``FEATURES``."""
    s = found.withColumn("s", F.col("secret"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("s", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    pairs = lambda pattern: F.regexp_count(kinds, F.lit(pattern))
    numbers = {
        "length": F.length("s"), "lower": _share("[a-z]"), "upper": _share("[A-Z]"), "digits": _share("[0-9]"),
        "other": _share("[^A-Za-z0-9]"), "distinct": F.size(F.array_distinct(F.split("s", ""))) / F.length("s"),
        # Where the kind of character changes; a lookahead counts overlapping pairs.
        "transitions": pairs("a(?=[^a])|A(?=[^A])|0(?=[^0])") / F.length("s"),
        "case_transitions": pairs("a(?=A)|A(?=a)") / F.length("s"),
        "digit_transitions": pairs("[aA](?=0)|0(?=[aA])") / F.length("s"),
        "vowels": _share("[aeiouAEIOU]"), "longest_letters": _longest("[A-Za-z]+"), "longest_same": _longest(r"(.)\1+"),
        "covered": 1 - F.length(F.regexp_replace("s", _WORDS, "")) / F.length("s"),
        "path": _share(r"[/.]"), "hex": F.col("s").rlike(r"^[0-9a-f]+$") | F.col("s").rlike(r"^[0-9A-F]+$"),
        "head": F.col("s").rlike(HEADS), "assigned": F.col("word").rlike(_ASSIGNED),
        "named_before": F.col("before").rlike(NAMES), "sign_before": F.col("sign"), "quoted": F.col("word").rlike(r"^[\"'`(]"),
    }
    return s.select("*", *[F.coalesce(numbers[n].cast("double"), F.lit(0.0)).alias(n) for n in FEATURES]).drop("s")


def _known() -> list[tuple[str, str, str, bool, float]]:
    """Rows (secret, word, before, sign, label) whose label is known whatever the table holds, many of them without a digit."""
    rng = random.Random(SEED)
    of = lambda n, signs: "".join(rng.choice(signs) for _ in range(n))
    name = lambda: rng.choice(("password", "secret", "token", "api_key", "passphrase"))
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice(("", "", "n", "r", "st")) for _ in range(rng.randint(2, 3)))
    rows = [("q7Rk29XvT4mB8nLc0WzE", "q7Rk29XvT4mB8nLc0WzE", "", False, 1.0), ("your-example-key-1234567", "your-example-key-1234567", "", False, 0.0)]
    for _ in range(KNOWN):
        phrase = "".join(word().title() + rng.choice("-!$#%*&@^~") for _ in range(rng.randint(2, 4)))
        token = of(rng.randint(16, 48), string.ascii_letters)
        for secret in (phrase, token):
            at = name()
            rows += [(secret, f"{at}={secret}", "", False, 1.0), (secret, secret, at, True, 1.0)]
        rows.append((token, token, "", False, 1.0))
        words = [word() for _ in range(rng.randint(3, 6))]
        joined = "".join(x.title() for x in words)
        for other in ("".join(words), "-".join(words), "/".join(words), joined, words[0] + joined, "_".join(words), of(1, string.ascii_letters) * rng.randint(12, 60)):
            rows.append((other, other, "", False, 0.0))
        at, called = name(), f"{words[0]}.{words[1]}{words[2].title()}()"
        rows.append((called, f"{at}={called}", "", False, 0.0))
        rows.append((f"your_{words[0]}_here", f"{at}=your_{words[0]}_here", "", False, 0.0))
    return rows


def labelled(found: DataFrame) -> DataFrame:
    """The candidates whose label follows from their form, their variants, and what is always known."""
    s = F.col("secret")
    with_digits = s.rlike("[A-Za-z]") & s.rlike("[0-9].*[^0-9].*[0-9]") & (F.length("secret") >= 12) & ~s.rlike(r"[/.]")
    named = F.col("word").rlike(_ASSIGNED) | (F.col("before").rlike(NAMES) & F.col("sign"))
    # Without digits: two changes of case, or marks between letters, and no word of the dictionary; not the names or calls of code.
    mixed = s.rlike(r"[a-z].*[A-Z].*[a-z].*[A-Z]") | s.rlike(r"[A-Za-z][^A-Za-z0-9\s._/()\[\]-].*[A-Za-z]")
    letters = ~s.rlike("[0-9]") & mixed & (F.length("secret") >= 12) & ~s.rlike(r"[/.()\[\]]") & ~s.rlike(_WORDS)
    # Words of letters, alone or joined, are no secrets where nothing names them so.
    prose = s.rlike(r"^[A-Za-z][a-z]*(?:[-_./][A-Za-z]?[a-z]*)*$") & ~s.rlike("(?i)[bcdfghjklmnpqrstvwxz]{5}") & ~named
    plain = prose | s.rlike(r"^[0-9+/_.~-]+$") | s.rlike(r"^(?:[a-z]+[./_-])+[a-z]*[0-9]{0,4}$") | s.rlike(r"(.)\1{5,}")
    label = F.when(s.rlike(HEADS) & (with_digits | letters), 1.0).when(named & (with_digits | letters), 1.0).when(plain, 0.0)
    label = F.when(F.length("secret") <= LONGEST_LABELLED, label)
    rows = found.withColumn("label", label).where("label is not null").select("secret", "word", "before", "sign", "label")
    rank = F.xxhash64("secret", "before")
    rows = rows.distinct().orderBy(rank, "secret", "word", "before", "sign").limit(MAX_FINDINGS)

    def variant(secret: Column, label: Column, keep: bool) -> Column:
        around = (F.col("before"), F.col("sign")) if keep else (F.lit(""), F.lit(False))
        return F.struct(
            secret.alias("secret"), (F.replace("word", F.col("secret"), secret) if keep else secret).alias("word"),
            around[0].alias("before"), around[1].alias("sign"), label.alias("label"),
        )

    half = F.substring("secret", 1, 6)
    spoiled = F.when(F.col("label") == 1.0, F.array(
        # Digits are no condition: the same with letters in their place.
        variant(F.translate("secret", "0123456789", "gkQxZmWvRj"), F.lit(1.0), True),
        variant(F.translate("secret", "0123456789", "gkQxZmWvRj"), F.lit(1.0), False),
        variant(F.repeat(F.substring("secret", 1, 1), F.length("secret")), F.lit(0.0), True),
        variant(F.concat(F.lit("your-example-token-"), half), F.lit(0.0), True),
        variant(F.concat(F.lit("src/main/module/"), half, F.lit("/index.html")), F.lit(0.0), False),
    )).otherwise(F.array())
    kinds = F.concat(F.array(variant(s, F.col("label"), True), variant(s, F.col("label"), False)), spoiled)
    rows = rows.select(F.inline(kinds))
    always = found.sparkSession.createDataFrame(_known(), "secret string, word string, before string, sign boolean, label double")
    return rows.union(always)


def train(found: DataFrame):
    """The forest, from a bounded sample of labelled findings among ``found``."""
    sample = stored(with_features(labelled(found)).repartitionByRange(4, "secret", "word").sortWithinPartitions("secret", "word", "before", "label"))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(sample)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, rule, n_chars, secret_sha256, score of the findings that the forest keeps."""
    found = stored(candidates(docs))
    scored = train(found).transform(with_features(found))
    rule = F.when(F.col("head") == 1, "issued head").when(
        (F.col("assigned") == 1) | ((F.col("named_before") == 1) & (F.col("sign_before") == 1)), "assigned"
    ).otherwise("long string")
    return scored.select(
        "doc_id", "start_word", rule.alias("rule"), F.length("secret").cast("bigint").alias("n_chars"),
        F.sha2("secret", 256).alias("secret_sha256"), vector_to_array("probability")[1].alias("score"),
    ).where(F.col("score") >= THRESHOLD)
