"""One query per operator over whole tables, and SQL where it can say the same."""

from pyspark.sql import functions as F

from cauce.llm import (
    bpe,
    jaccard,
    language,
    middle,
    packing,
    perplexity,
    planes,
    recipes,
    secrets,
    severity,
    suffixes,
    token_files,
    vectors,
)
from cauce.llm.common import documents, shared_folder


def public_vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark, sf_dir):
    folder = shared_folder(spark, "token-files")
    index = token_files.write_token_files(
        documents(spark, sf_dir), folder, public_vocabulary("byte_bpe_50k.json")
    )
    read = token_files.read_token_files(index, folder)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "place")


def op2_exact_dedup(spark, sf_dir):
    return recipes.exact_duplicates(documents(spark, sf_dir))


def language_model(docs):
    """Learnt from text and lang of the documents that are not held out; their ids only draw the sample."""
    train = docs.filter(~language.held_out()).select("doc_id", "text", "lang")
    return language.fit(train, public_vocabulary("piece_bpe_32k.model"))


def op3_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language_model(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op4_packing(spark, sf_dir):
    packed = packing.pack(documents(spark, sf_dir), public_vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


def op9_jaccard_join(spark, sf_dir):
    docs = jaccard.numbered(documents(spark, sf_dir))
    return jaccard.similar_documents(docs, size=3, num=90, den=100).drop("row", "kept")


def op5_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, digests_only=True)


def op7_embedding_dedup(spark, sf_dir):
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_secret_scan(spark, sf_dir):
    rows, row = secrets.numbered(documents(spark, sf_dir).select("doc_id", "text"))
    return secrets.scan(rows, row).drop("row", "nth")


def op10_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = severity.fit(severity.labelled_texts(docs, labels))
    return severity.grade(docs, model)


def op11_quality_rules(spark, sf_dir):
    return perplexity.quality(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op12_fill_in_middle(spark, sf_dir):
    return middle.fill_in_middle(documents(spark, sf_dir), digests_only=True)


def op13_centroid_clustering(spark, sf_dir):
    found = planes.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid", digest).withColumnRenamed("centroid", "centroid_sha256")


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language": op3_language,
    "op4_packing": op4_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_quality_rules": op11_quality_rules,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_centroid_clustering": op13_centroid_clustering,
}


def _centroid_sql(k=16, rounds=3):
    """The rounds of op13 one after the other; sums by component, floors by the remainder."""
    parts = [
        """v AS (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings WHERE len(embedding) = 64
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) - 1 AS c, e FROM v
            QUALIFY c < %d
        )""" % k
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS (
            SELECT row, min((list_sum(list_transform(list_zip(v.e, c{i}.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
                c))  AS near FROM v, c{i} GROUP BY row
        )"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (
            SELECT near[2] AS c, place, sum(v.e[place])::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM a{i} JOIN v USING (row), range(1, 65) r(place) GROUP BY 1, 2
        ), c{i + 1} AS (
            SELECT c{i}.c, coalesce(list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY place) FILTER (n IS NOT NULL), any_value(c{i}.e)) AS e
            FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c GROUP BY c{i}.c
        )"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, near[2]::INTEGER AS cluster, near[1] AS distance,
            (sum(near[1]) OVER (PARTITION BY near[2]))::BIGINT AS cluster_inertia, (sum(near[1]) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(c{rounds}.e, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (row) JOIN c{rounds} ON c = near[2]"""


ORACLE = {
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY text)
    """,
    "op7_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), l AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
            WHERE len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93
        ), r AS (
            SELECT DISTINCT a AS id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id
        ), n AS (
            SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
        ), c AS (
            SELECT id AS vec_id, min(root) AS root FROM r GROUP BY id
        )
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id,
            coalesce(root, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
    """,
    "op9_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
            FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), c AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)
        ), e AS (
            SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), r AS (
            SELECT DISTINCT a AS id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id
        )
        SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, coalesce(min(r.root), d.doc_id) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.id = d.doc_id GROUP BY d.doc_id
    """,
    "op12_fill_in_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
            FROM documents
        ), h AS (
            SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
            FROM t
        ), f AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM h
        ), p AS (
            SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
                array_to_string(w[b + 1:], '') AS suffix
            FROM f
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
            sha256(prefix || middle || suffix) AS restored_sha256
        FROM p
    """,
    "op13_centroid_clustering": _centroid_sql(),
}
