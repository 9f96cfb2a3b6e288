"""The registered queries of this subpackage and their SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import chat, line_dedup, line_rules, merkle, mixing, near_dedup, ordinal, packing, prefix_trie, secret_scan, substring, topk, toxicity
from waymark.llm.text import table
from waymark.plans.registry import Query
from waymark.session import written

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op2_substring_dedup", r"""
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
    ), w AS (
        SELECT doc_id, i, list_slice(words, i, i + 49) AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)
    ), f AS (SELECT win, min(doc_id) AS first_doc FROM w GROUP BY win HAVING min(doc_id) < max(doc_id)
    ), r AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM w JOIN f USING (win) WHERE doc_id > first_doc
    ), g AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id
    )
    SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
           sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
    FROM d LEFT JOIN g ON d.doc_id = g.doc_id""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_line_quality")
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_rules.judge(docs, line_rules.fit_field(docs, table(spark, sf_dir, "labels"))).drop("line_states")


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_chat_format", r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), e AS (
        SELECT *, regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|/?SYS>>|\|system\|>|\|user\|>|\|assistant\|>|\|endoftext\|>)', '\1\2\\\3', 'g') AS body FROM c
    )
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(12 + length(role) + 1 + length(body) + 11)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id""")
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat.formatted(chat.canonical_turns(chat.records_of(rows)))
    back = out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: Target weights of the mixture; names that are missing weigh 1.
MIXTURE = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}


def _mixture_sql(percent: int, max_epochs: int, seed: int) -> str:
    weight = lambda level: "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in MIXTURE.get(level, {"": 1}).items()) + " ELSE 1 END"
    ctes, path, parent = [], [], "(SELECT sum(tokens) * %d // 100 AS budget FROM leaf)" % percent
    for level in mixing.LEVELS:
        keys, on = ", ".join([*path, level]), f"USING ({', '.join(path)})" if path else "ON true"
        part = f"PARTITION BY {', '.join(path)}" if path else ""
        order = f"({part} ORDER BY supply / weight, {level}"
        ctes.append(f"""
    {level}_n AS (SELECT {keys}, sum(tokens) * {max_epochs} AS supply, {weight(level)} AS weight FROM leaf GROUP BY {keys}),
    {level}_s AS (
        SELECT *, row_number() OVER {order}) AS place, budget - coalesce(sum(supply) OVER {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
               sum(weight) OVER {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS among
        FROM {level}_n JOIN {parent} {on}),
    {level}_t AS (SELECT *, min(CASE WHEN supply * among > rest * weight THEN place END) OVER ({part}) AS stop FROM {level}_s),
    {level}_b AS (
        SELECT {keys}, (CASE WHEN stop IS NULL OR place < stop THEN supply ELSE
               max(CASE WHEN place = stop THEN rest END) OVER ({part}) * weight // max(CASE WHEN place = stop THEN among END) OVER ({part}) END)::HUGEINT AS budget
        FROM {level}_t)""")
        path.append(level)
        parent = f"{level}_b"
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
               'domain' || coalesce((instr('0123456789abcdef', substr(md5(source), 1, 1)) - 1) // 4, 0) AS domain FROM documents
    ), leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),{','.join(ctes)},
    plan AS (SELECT *, budget // tokens AS epochs, budget - budget // tokens * tokens AS rest FROM leaf JOIN {parent} USING (domain, lang, source) WHERE tokens > 0),
    h AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{seed}:' || epochs || ':' || doc_id)) AS reached FROM d JOIN plan USING (domain, lang, source)),
    e AS (SELECT *, unnest(range(0, (epochs + CASE WHEN rest > 0 AND reached <= rest THEN 1 ELSE 0 END)::BIGINT)) AS epoch FROM h)
    SELECT doc_id, epoch::BIGINT AS epoch, domain, lang, source, n_tokens::BIGINT AS n_tokens FROM e"""


@query("op10_source_mixture", _mixture_sql(50, 2, 7))
def op10_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIXTURE, percent=50, max_epochs=2, seed=7).select("document.doc_id", "epoch", *mixing.LEVELS, "n_tokens")


@query("op6_top_k", """
    WITH v AS (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS n FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), s AS (
        SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.n, b.n)::BIGINT AS score,
               row_number() OVER (PARTITION BY a.rid ORDER BY list_inner_product(a.n, b.n) DESC, b.vec_id) AS rank
        FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.rid <> b.rid
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM s WHERE rank <= 20""")
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.whole_numbers(F.col("embedding"), 64).alias("numbers"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


@query("op1_near_dedup")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, index).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "evidence_ids", "evidence_cosines")


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 for poor texts, 1 for good ones that are toxic, 2 for good ones that aren't."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


@query("op3_quality_grades")
def op3_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.grade(docs, ordinal.fit(docs, ratings(table(spark, sf_dir, "labels"))))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = written(secret_scan.candidates(docs), "candidates")
    model = secret_scan.fit(secret_scan.labelled_by_name(found), secret_scan.learn_dictionary(docs))
    return secret_scan.scan(found, model).select("doc_id", "place", "start", F.char_length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


def _crc32_sql(text: str) -> str:
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: {bits}), 4294967295)"


#: Levels that the SQL climbs: enough for eight to their power of leaves and of subroots.
SQL_LEVELS = {"leaf": 7, "top": 3}


def _merkle_sql() -> str:
    fields = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in merkle.FIELDS[:-1])
    whole = f"sha256({fields} || coalesce(strlen(text) || ':' || text, '-'))"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN sha256({fields} || coalesce(strlen(text) || ':' || {lowered}, '-')) ELSE {whole} END"
    ctes = [
        f"d AS (SELECT doc_id, coalesce(':' || lang, '-') AS tree, {whole} AS leaf, {changed} AS changed FROM documents)",
        "leaf_0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h FROM d)",
    ]

    def climb(name: str, levels: int) -> None:
        for k in range(levels):
            run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
            ctes.append(f"""{name}_s{k} AS (SELECT tree, i, count(*) OVER (PARTITION BY tree) AS n, h,
                coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}_{k})""")
            ctes.append(f"{name}_{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}_s{k} GROUP BY tree, i // 8)")

    def up(name: str, levels: int, start: str) -> str:
        for k in range(levels):
            ctes.append(f"""{name}_p{k} AS (SELECT p.* EXCLUDE (i, proof, folded), p.i // 8 AS i, proof || CASE WHEN n > 1 THEN l || r ELSE '' END AS proof,
                CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded FROM {start} p JOIN {name}_s{k} s ON p.tree = s.tree AND p.i = s.i)""")
            start = f"{name}_p{k}"
        return start

    climb("leaf", SQL_LEVELS["leaf"])
    ctes.append(f"top_0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY CASE WHEN tree = '-' THEN 0 ELSE 1 END, tree) - 1 AS i, h, tree AS lang FROM leaf_{SQL_LEVELS['leaf']})")
    climb("top", SQL_LEVELS["top"])
    ctes.append("start AS (SELECT doc_id, tree, leaf, changed AS folded, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)")
    done = up("leaf", SQL_LEVELS["leaf"], "start")
    ctes.append(f"between AS (SELECT p.doc_id, p.leaf, t.h AS subroot, '' AS tree, t.i, p.folded, p.proof FROM {done} p JOIN top_0 t ON p.tree = t.lang)")
    done = up("top", SQL_LEVELS["top"], "between")
    return f"""WITH {", ".join(ctes)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
        FROM {done}, top_{SQL_LEVELS["top"]} t"""


@query("op11_merkle_manifest", _merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest_of(*[F.col(c) for c in merkle.FIELDS[:-1]], lowered))
    proofs = merkle.manifest(table(spark, sf_dir, "documents"), carried={"altered": altered})
    back = merkle.folded(F.coalesce("altered", "leaf"), F.col("path"))
    return proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_line_dedup", """
    WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM s),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT doc_id, place, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN g USING (key))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op12_prefix_trie", f"""
    WITH t AS (
        SELECT conv_id AS c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS bytes,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT c, c - c % 5 AS base, {_crc32_sql('c::VARCHAR')} % 9 AS head FROM (SELECT DISTINCT c FROM t)),
    first AS (SELECT c.c, t.k AS d, t.h, t.bytes FROM c JOIN t ON t.c = c.base AND t.k <= c.head),
    length AS (SELECT c.c, count(f.c) AS n FROM c LEFT JOIN first f ON f.c = c.c GROUP BY c.c),
    r AS (SELECT * FROM first UNION ALL SELECT c.c, n + t.k - head, t.h, t.bytes FROM c JOIN length USING (c) JOIN t ON t.c = c.c AND t.k > head),
    p AS (SELECT c, d, bytes, string_agg(h, '') OVER (PARTITION BY c ORDER BY d) AS path FROM r UNION ALL SELECT c, 0, 0, '' FROM c),
    e AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
    n AS (SELECT path, d AS depth, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM e GROUP BY path, d),
    k AS (SELECT n.*, u.conv_id AS parent_conv_id, count(*) OVER (PARTITION BY u.path) AS siblings, u.path AS above
          FROM n LEFT JOIN n u ON u.depth = n.depth - 1 AND u.path = substr(n.path, 1, 64 * (n.depth - 1))),
    f AS (SELECT n.path, max(k.siblings) AS n_children FROM n JOIN k ON k.above = n.path GROUP BY n.path),
    s AS (SELECT a.path, count(*) FILTER (f.path IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved_tokens
          FROM n a JOIN n b ON substr(b.path, 1, 64 * a.depth) = a.path LEFT JOIN f ON f.path = b.path GROUP BY a.path)
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
           saved_tokens::BIGINT AS saved_tokens, ends_sha256
    FROM k JOIN s USING (path) LEFT JOIN f USING (path)""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % 5, F.crc32(conv.cast("string")) % 9)
