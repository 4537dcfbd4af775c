"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers

from . import chat, codes, embedding, exact, lines, lm, mixing, packing, pieces, pii, search, simhash, toxicity


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_sentencepiece(spark, sf_dir):
    """All samples of every text, and whether each decodes to the text."""
    rows = pieces.encode(_docs(spark, sf_dir).select("doc_id", "text"), verify=True)
    return rows.select("doc_id", "pieces", "log_prob", "perturbed", "log_inclusion", "decodes")


def op3_exact_dedup(spark, sf_dir):
    return exact.exact_classes(_docs(spark, sf_dir))


def op4_embedding_near_dedup(spark, sf_dir):
    return embedding.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op5_mixing(spark, sf_dir):
    return mixing.mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash_near_dedup(spark, sf_dir):
    rows = simhash.simhash_classes(_docs(spark, sf_dir), shingle=4, max_bits=4)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_pii(spark, sf_dir):
    return pii.digest(pii.find_personal_data(_docs(spark, sf_dir)))


def op8_lm_scoring(spark, sf_dir):
    return lm.score_lm(_docs(spark, sf_dir))


def op9_chat_formatting(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_chat(turns.union(more)))


def op10_line_dedup(spark, sf_dir):
    rows = lines.dedup_lines(_docs(spark, sf_dir), max_edits=lines.MAX_EDITS, similarity=lines.SIMILARITY, min_words=lines.MIN_WORDS, report=True)
    return rows.select("doc_id", "text", "n_lines", "dropped_lines")


def op11_vector_codes(spark, sf_dir):
    return codes.digest(codes.train_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op12_packing(spark, sf_dir):
    return packing.digest(packing.pack(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


def op13_lexical_search(spark, sf_dir):
    index = search.build_index(_docs(spark, sf_dir))
    return search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_sentencepiece, op3_exact_dedup, op4_embedding_near_dedup, op5_mixing,
                                   op6_simhash_near_dedup, op7_pii, op8_lm_scoring, op9_chat_formatting, op10_line_dedup,
                                   op11_vector_codes, op12_packing, op13_lexical_search)}



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every round of the codebooks as a step of its own, by full search."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} as materialized (select vec_id, label, part, x, arg_min(entry, (d, entry)) as entry, min(d) as d from
              (select p.*, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
               from p join c{r} c on c.part = p.part) group by all)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} as materialized (select c.part, c.entry, coalesce(m.x, c.x) as x from c{r} c left join
              (select part, entry, list(y order by i) as x from
                   (select part, entry, i, floor(sum(x[i])::double / count(*))::bigint as y
                    from a{r}, (select unnest(range(1, (select len(x) from p limit 1) + 1)) as i) group by part, entry, i) group by part, entry) m
              on m.part = c.part and m.entry = c.entry)""")
    return f"""
        with k as materialized (select vec_id, label, list_transform(embedding::double[], lambda x: floor({scale} * x)::bigint) as q from embeddings
              where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as materialized (select vec_id, label, part, q[part * (len(q) // {parts}) + 1 : (part + 1) * (len(q) // {parts})] as x
              from k, (select unnest(range({parts})) as part)),
        c0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as entry, x from p
              qualify row_number() over (partition by part order by vec_id) <= {entries}),{",".join(steps)},
        v as (select vec_id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by vec_id, label)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
               (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) from c{rounds}) as codebooks_sha256 from v"""


ORACLE_SQL = {
    "op11_vector_codes": _codes_sql(),
    "op13_lexical_search": r"""
        with t as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
        f as (select doc_id, term, count(*) as tf from t group by all),
        d as (select doc_id, sum(tf)::bigint as n from f group by doc_id),
        s as (select count(*) as n_docs, sum(n)::bigint as n_terms from d),
        w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from f, s group by term, n_docs),
        i as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
        r as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
              from i join f using (term) join d using (doc_id) join w using (term), s group by item_id, doc_id)
        select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from r
        where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10""",
    "op4_embedding_near_dedup": """
        with recursive
        v as (select vec_id, embedding::double[] as e from embeddings),
        u as (select * from v where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(e, lambda x: x <> 0)) > 0),
        link as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
                 where list_cosine_similarity(a.e, b.e) >= 0.9),
        reach(a, b) as (select vec_id, vec_id from v union select r.a, l.b from reach r join link l on l.a = r.b),
        low as (select a, min(b) as component_id from reach group by a),
        n as (select a, count(*) as n_links from link group by a)
        select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
        from v left join n on n.a = vec_id join low on low.a = vec_id""",
    "op3_exact_dedup": r"""
        with t as (select doc_id, length(coalesce(text, '')) as points,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by body) as group_size,
               row_number() over w = 1 as kept, sha256(body) as text_sha256
        from t window w as (partition by body order by points desc, doc_id nulls last)""",
    "op9_chat_formatting": r"""
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f as (select *, '### ' || replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), '<|', '\p'), ': ', '\c') || ': '
                     || replace(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'), '<|', '\p') || '</turn>' || chr(10) as segment from t)
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, segment)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, segment) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length(segment))::bigint as formatted_chars
        from f group by conv_id""",
}
