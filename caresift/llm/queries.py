"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from caresift.llm import (
    bitpack,
    decision_lists,
    decontam,
    divergence,
    langid,
    mixing,
    pii,
    prefix_trie,
    reputation,
    simhash_vp,
    tagpaths,
    toxicity,
    warc,
)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_langid": langid.op2_langid,
    "op3_url_reputation": reputation.op3_url_reputation,
    "op4_pii": pii.op4_pii,
    "op5_mixing": mixing.op5_mixing,
    "op6_bitpack": bitpack.op6_bitpack,
    "op7_tag_paths": tagpaths.op7_tag_paths,
    "op8_decision_list": decision_lists.op8_decision_list,
    "op9_simhash_vp": simhash_vp.op9_simhash_vp,
    "op10_decontam": decontam.op10_decontam,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES: dict[str, str] = {
    "op3_url_reputation": reputation.OP3_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), d AS (
            SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p
        ), m AS (
            SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM d
        ), b AS (
            SELECT *, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INT + 1, 1), '' ORDER BY i)
                FROM range(32) r(i)) AS payload_digest FROM m
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM b""",
}
