"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, decontaminate, jaccard_join, license_scan, lm_score, packing, pipeline, quality_model, quality_rules, sharding, spelling, substring_dedup, url_filter, vector_codes

QUERIES = {
    "op1_lm_score": lm_score.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_quality_classifier": quality_model.query,
    "op4_packing": packing.query,
    "op5_decontaminate": decontaminate.query,
    "op6_sharding": sharding.query,
    "op7_quality_rules": quality_rules.query,
    "op8_license_scan": license_scan.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_url_filter": url_filter.query,
    "op11_spelling_variants": spelling.query,
    "op12_byte_bpe": byte_bpe.query,
    "op13_vector_codes": vector_codes.query,
    "pipeline": pipeline.run,
}

def _codebook_rounds() -> str:
    """The rounds of op13's codebooks, one common table after the other, and the last assignment."""
    out = []
    for k in range(vector_codes.ROUNDS + 1):
        out.append(f"near{k} as (select vec_id, part, arg_min(entry, (far, entry)) as entry, min(far) as far from (select v.vec_id, v.part, c.entry, list_sum([(x - y) * (x - y) for x, y in list_zip(v.xs, c.xs)]) as far from cut v join book{k} c on v.part = c.part) group by v.vec_id, v.part)".replace("for x, y in list_zip(v.xs, c.xs)", "for z in list_zip(v.xs, c.xs)").replace("(x - y) * (x - y)", "(z[1] - z[2]) * (z[1] - z[2])").replace("group by v.vec_id, v.part", "group by vec_id, part"))
        if k < vector_codes.ROUNDS:
            out.append(f"mean{k} as (select part, entry, list((s - ((s % n) + n) % n) // n order by place) as xs from (select part, entry, place, sum(x)::hugeint as s, count(*) as n from (select a.part, a.entry, unnest(range(1, len(v.xs) + 1)) as place, unnest(v.xs) as x from near{k} a join cut v using (vec_id, part)) group by part, entry, place) group by part, entry)")
            out.append(f"book{k + 1} as materialized (select b.part, b.entry, coalesce(m.xs, b.xs) as xs from book{k} b left join mean{k} m using (part, entry))")
    return ", ".join(out)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op5_decontaminate": f"""
        with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
        b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
        items as (select item_id, least(10, len(w)) as n, unnest([array_to_string(w[i : i + least(10, len(w)) - 1], ' ') for i in range(1, len(w) - least(10, len(w)) + 2)]) as s from b where len(w) > 0),
        sizes as (select distinct n from items),
        places as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from w, sizes where len(w) >= n),
        hits as (select distinct a.doc_id, a.i, a.n, t.item_id from places a join items t on t.n = a.n and t.s = array_to_string(a.w[a.i : a.i + a.n - 1], ' ')),
        words as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
        found as (select doc_id, count(distinct item_id) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, item_id, cast(item_id as varchar) as id from hits) group by doc_id)
        select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from w left join words using (doc_id) left join found using (doc_id)""",
    "op9_jaccard_join": f"""
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else [array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)] end) as g from w),
        n as (select w.doc_id, count(g) as n from w left join s using (doc_id) group by w.doc_id),
        shared as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b using (g) where a.doc_id <> b.doc_id group by 1, 2),
        links as materialized (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 85 * (x.n + y.n - common)),
        reach as (select doc_id as a, doc_id as b from n union select r.a, l.b from reach r join links l on r.b = l.a)
        select doc_id, n as n_shingles, lowest as component_id from n join (select a as doc_id, min(b) as lowest from reach group by a) using (doc_id)""",
    "op10_url_filter": f"""
        with p as (select page_id, case when url like '%://%' then substr(url, position('://' in url) + 3) else '' end as rest from pages),
        h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
        rules as (select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as t(rh, rp, v)),
        best as (select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(v, length(rh || rp)) as v from h, rules where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
        select h.page_id, host, path, rule, coalesce(v, 'allow') as verdict from h left join best using (page_id)""",
    "op11_spelling_variants": f"""
        with recursive steps(k, i, c) as (select k, 0, k::bigint from range(256) t(k) union all select k, i + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from steps where i < 8),
        crc as (select list(c order by k) as t from steps where i = 8),
        runs as (select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) as w from documents),
        counted as (select id, w, count(*) as k from runs where length(w) >= 7 group by id, w),
        bytes as (select id, w, k, encode(id || ':' || w) as b from counted),
        hashed as (select id, w, k, xor(list_reduce(list_prepend(4294967295::bigint, [('0x' || hex(b)[2 * i - 1 : 2 * i])::bigint for i in range(1, octet_length(b) + 1)]), lambda h, x: xor(h // 256, t[(xor(h, x) % 256) + 1])), 4294967295) as h from bytes, crc),
        typed as (select case when h % 31 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, k from hashed),
        words as materialized (select word, sum(k)::bigint as n from typed where length(word) >= 7 group by word having sum(k) >= 2),
        cut as materialized (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
        near as (select a.word, a.n, b.word as other, b.n as m from cut a join cut b using (i, rest) where a.word <> b.word union select c.word, c.n, w.word, w.n from cut c join words w on c.rest = w.word union select w.word, w.n, c.word, c.n from cut c join words w on c.rest = w.word),
        best as (select word, count(*) as n_near, max(m) as m, arg_min(other, (-m, other)) as other from near group by word),
        forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * w.n then other end as form, case when m >= 10 * w.n then m end as form_n from words w left join best using (word)),
        chains(word, place, k) as (select word, word, 0 from words union all select c.word, f.form, k + 1 from chains c join forms f on c.place = f.word where f.form is not null)
        select word, form, arg_max(place, k) as root, n, n_near, form_n from forms join chains using (word) group by word, form, n, n_near, form_n""",
    "op13_vector_codes": f"""
        with kept as (select vec_id, label, [floor(4096 * x::double)::bigint for x in embedding] as xs from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        cut as materialized (select vec_id, part, xs[part * (len(xs) // 8) + 1 : (part + 1) * (len(xs) // 8)] as xs from kept, range(8) t(part)),
        ranked as (select vec_id, row_number() over (order by vec_id) - 1 as entry from kept),
        book0 as materialized (select part, entry, xs from cut join ranked using (vec_id) where entry < 16),
        {_codebook_rounds()},
        codes as (select vec_id, string_agg(format('{{:02x}}', entry), '' order by part) as code, sum(far)::bigint as error from near{vector_codes.ROUNDS} group by vec_id),
        digest as (select sha256(string_agg(array_to_string(xs, ','), ',' order by part, entry)) as d from book{vector_codes.ROUNDS})
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, d as codebooks_sha256 from codes join kept using (vec_id), digest""",
}
