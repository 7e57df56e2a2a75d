"""Secret scanning: candidates from text, and a random forest that removes false findings. DataFrame work only."""

from __future__ import annotations

import functools
import operator

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import share_of, staged
from tidelog.session import scratch_path

# A run of characters of tokens, ids and addresses.
TOKEN = r"[A-Za-z0-9_+/=.@:~-]"
# name=, name: or a quoted name, and how a value starts; then a value in quotes, or one up to the next name or closing bracket.
NAMED = r"""-{0,2}([A-Za-z_][A-Za-z0-9_-]{2,30})\\?["'`]?(?:=>|:=|[=:])(?![=>]|//)"""
VALUE = (r"""(?:\\?"[^"\s\\]+|\\?'[^'\s\\]+|\\?`[^`\s\\]+|"""
         r"""(?:(?![,;&|]["'`]?[A-Za-z_][A-Za-z0-9_-]*["'`]?[=:])(?![)\]}]+(?:[.,;:)\]}]|$))[^\s"'`<>\\])+)""")
PIECE = rf"(?<!{TOKEN}){NAMED}{VALUE}|{TOKEN}{{12,}}"
# What counts if a run has no such piece: its printable characters between quotes and brackets.
OTHER = r"""[!-~&&[^"'`()<>\[\]{},;]]{12,}"""
WRAPPING = r"""^[\s"'`(<\[{,;\\]+|[\s"'`)>\]},;.:!?#*\\]+$"""
# A run that ends in name= or name:, so that the next run is its value.
NAME_ENDS = r"""[A-Za-z_][A-Za-z0-9_-]{2,30}\\?["'`]?(=>|:=|[=:])$"""
NAME_ONLY = r"""[A-Za-z_][A-Za-z0-9_-]{2,30}["'`]?$"""
# Parts of words that make up readable names, for dictionary coverage; a parameter of the operator.
DICTIONARY = (
    "access", "account", "admin", "alpha", "android", "apache", "api", "app", "archive", "asset", "backup", "beta", "blog",
    "build", "cache", "client", "cloud", "com", "common", "config", "content", "control", "core", "data", "default", "demo",
    "dev", "docs", "email", "error", "example", "file", "form", "group", "home", "host", "html", "http", "image", "index",
    "info", "internal", "item", "lib", "list", "local", "login", "mail", "main", "master", "media", "module", "name", "net",
    "node", "object", "online", "order", "org", "package", "page", "post", "prod", "project", "public", "release", "remote",
    "report", "sample", "search", "server", "service", "site", "source", "static", "store", "support", "system", "table",
    "temp", "test", "text", "type", "update", "user", "value", "version", "video", "view", "web", "work", "www",
)
KEYWORDS = r"(?i)passw|passphrase|pwd|secret|token|api.?key|access.?key|auth|credential|bearer|private"
PLACEHOLDERS = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|redacted|<.*>"
FEATURES = ("size", "digits", "uppers", "lowers", "others", "moves_letter_digit", "moves_case", "moves_other", "distinct",
            "hexlike", "dictionary", "path_depth", "path_test", "path_config", "keyword_near", "placeholder_near",
            "assigned", "quoted")


def candidates(documents: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, path, position, candidate, before, after, quoted, assigned) of (doc_id, text, path).

    Text is cut into runs at white space. A run's candidates are the values assigned in it (name=value, name:value,
    "name":"value"; 8 characters or more), with the name as a neighbour, and its other stretches of 12 or more characters of
    tokens, ids and addresses. A run after name= or name: is a value as a whole. A run with none of them counts as far as it
    has 12 printable characters without quotes and brackets. All have a letter and a digit, for assigned ones the name
    included if it is in the run. What surrounds a candidate is stripped, and a value keeps punctuation inside it.
    position is the number of the run in the whole text; before and after hold up to two neighbours each.
    """
    bare = lambda x: F.regexp_replace(x, WRAPPING, "")
    mixed = lambda x: x.rlike("[0-9]") & x.rlike("[A-Za-z]")
    at = lambda i: F.coalesce(F.get("runs", i), F.lit(""))
    looks = lambda i: (F.length(at(i)) >= 8) & mixed(at(i))
    near = lambda i: F.struct(
        i.alias("position"), at(i).alias("run"), at(i - 2).alias("second"), at(i - 1).alias("first"),
        F.concat_ws(" ", at(i + 1), at(i + 2)).alias("after"))
    rows = (
        documents.select("doc_id", F.col(path).alias("path"), "text").filter(F.col("text").rlike("[0-9]"))
        .select("doc_id", "path", F.split(F.col("text"), r"\s+").alias("runs"))
        .select("doc_id", "path", F.explode(F.transform(
            F.filter(F.sequence(F.lit(0), F.size("runs") - 1), looks), near)).alias("near"))
        .select("doc_id", "path", "near.*").withColumn("left", F.concat_ws(" ", "second", "first")))
    every = lambda pattern: F.regexp_extract_all("run", F.lit(pattern), F.lit(0))
    value_of = F.col("first").rlike(NAME_ENDS) | (F.col("first").isin("=", ":", "=>", ":=") & F.col("second").rlike(NAME_ONLY))
    whole = F.regexp_extract(F.regexp_replace("run", r"^[(\[{]+", ""), f"^{VALUE}", 0)
    parts = F.filter(every(PIECE), mixed)
    plain_value = value_of & ~F.col("run").rlike(f"^{TOKEN}*://") & ~F.col("run").rlike(rf"^\W*{NAMED}") & mixed(whole)
    pieces = (
        F.when(plain_value, F.concat(F.array(whole), F.filter(parts, lambda x: ~F.contains(whole, x))))
        .when(F.size(parts) > 0, parts).otherwise(F.filter(every(OTHER), mixed)))
    rows = rows.withColumn("value_of", value_of).withColumn("piece", F.explode(pieces))
    rows = rows.withColumn("name", F.regexp_extract("piece", f"^{NAMED}{VALUE}", 1)).withColumn(
        "candidate", bare(F.when(F.col("name") != "", F.regexp_replace("piece", f"^{NAMED}", "")).otherwise(F.col("piece"))))
    quote = [F.lit(q) for q in "\"'`"]
    beside = [F.contains("run", F.concat(*x)) for q in quote for x in ((q, F.col("candidate")), (F.col("candidate"), q))]
    assigned = (F.col("name") != "") | F.col("left").rlike(r"[=:]\s*$")
    return rows.select(
        "doc_id", "path", "position", "candidate",
        F.when(F.col("name") != "", F.concat_ws(" ", "left", "name")).otherwise(F.col("left")).alias("before"), "after",
        functools.reduce(operator.or_, beside).alias("quoted"), assigned.alias("assigned"),
        ((F.col("name") != "") | F.col("value_of")).alias("valued"),
    ).filter(F.length("candidate") >= F.when(F.col("valued"), 8).otherwise(12)).drop("valued")


def described(findings: DataFrame, dictionary: tuple[str, ...] = DICTIONARY) -> DataFrame:
    """findings with the forest's FEATURES: length, character transitions, dictionary coverage, path, neighbours."""
    c, n = F.col("candidate"), F.greatest(F.length("candidate"), F.lit(1)).cast("double")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    rest = F.length(F.regexp_replace(F.lower(c), words, ""))
    path, near = F.coalesce(F.col("path"), F.lit("")), F.concat_ws(" ", "before", "after")
    number = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    columns: dict[str, Column] = {
        "size": F.log1p(n), "digits": count("[0-9]"), "uppers": count("[A-Z]"), "lowers": count("[a-z]"),
        "others": count("[^A-Za-z0-9]"),
        "moves_letter_digit": count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"),
        "moves_case": count("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "moves_other": count("(?<=[A-Za-z0-9])(?=[^A-Za-z0-9])"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hexlike": c.rlike("^[0-9a-f]{16,}$|^[0-9A-F]{16,}$"), "dictionary": (n - rest) / n,
        "path_depth": F.regexp_count(path, F.lit("/")), "path_test": path.rlike("(?i)test|example|sample|doc"),
        "path_config": path.rlike(r"(?i)\.(env|ini|cfg|conf|ya?ml|json|properties|tf)$"),
        "keyword_near": F.col("before").rlike(KEYWORDS), "placeholder_near": near.rlike(PLACEHOLDERS) | c.rlike(PLACEHOLDERS),
        "assigned": F.col("assigned"), "quoted": F.col("quoted"),
    }
    return findings.withColumns({f"f_{k}": number(v) for k, v in columns.items()})


def train_forest(labelled: DataFrame, *, max_rows: int = 20_000, trees: int = 24, depth: int = 7,
                 seed: int = 5) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (the columns of candidates, and real: 1 for a secret, 0 for a false alarm).

    Fitted on at most about max_rows of them, drawn by a hash of the candidate. None without rows of both kinds.
    """
    rows = labelled.filter(F.col("real").isin(0, 1))
    n, kinds = rows.agg(F.count("*"), F.count_distinct("real")).first()
    if kinds < 2:
        return None
    drawn = staged(described(rows.filter(share_of(n, max_rows, F.col("candidate"), seed))).select(
        *[f"f_{k}" for k in FEATURES], F.col("real").cast("double").alias("real")))
    forest = RandomForestClassifier(featuresCol="forest_in", labelCol="real", numTrees=trees, maxDepth=depth, seed=seed)
    fitted = forest.fit(VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="forest_in").transform(drawn))
    # A fitted model holds its training summary, which holds the session, which no task can take once anything in the
    # session was observed. A stored model is the trees alone.
    path = scratch_path(labelled.sparkSession, "forest")
    fitted.save(path)
    return RandomForestClassificationModel.load(path)


def scan(documents: DataFrame, labelled: DataFrame, path: str = "source", threshold: float = 0.5) -> DataFrame:
    """Every candidate of every row with its probability of being a secret, and secret: whether it reaches the threshold.

    Null and empty texts have no candidates; rows with null or repeated ids are scanned like others. If labelled has not
    both kinds, nothing is filtered: all candidates count as secrets with probability 1.
    """
    found = candidates(documents, path)
    forest = train_forest(labelled)
    if forest is None:
        return found.withColumn("probability", F.lit(1.0)).withColumn("secret", F.lit(True))
    ready = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="forest_in").transform(described(found))
    scored = forest.transform(ready).withColumn("probability", vector_to_array("probability")[1])
    return scored.select(*found.columns, "probability", (F.col("probability") >= threshold).alias("secret"))


def reviewed(findings: DataFrame) -> DataFrame:
    """findings with real where a reviewer's plain rules are sure: 1 for issued key formats and values assigned to a
    credential's name, 0 for mail and web addresses, hosts and dates. They stand in for a reviewed list."""
    c = F.col("candidate")
    address = c.rlike(r"^[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$") | c.rlike("://") | c.rlike(
        r"^([A-Za-z0-9-]+\.)+[A-Za-z]{2,}(:\d+)?(/|$)") | c.rlike(r"^\d{4}-\d\d-\d\dT[\d:.Z+-]+$")
    real = c.rlike("^(AKIA|ASIA)[A-Z0-9]{16}$") | (F.col("before").rlike(KEYWORDS) & F.col("assigned"))
    return findings.withColumn("real", F.when(address, 0).when(real & ~c.rlike(PLACEHOLDERS), 1)).filter("real is not null")
