"""The operators' results in SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        with texts as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') as t
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
        from texts window same as (partition by t)""",
    "op12_decontamination": r"""
        with texts as (
            select row_number() over () as row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents),
        items as (
            select item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark),
        starts as (
            select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from items where len(w) > 0),
        windows as (
            select distinct item_id, least(10, len(w)) as n, array_to_string(w[s:s + 9], ' ') as words
            from starts),
        sizes as (select distinct n from windows),
        places as (
            select row, w, n, unnest(range(1, len(w) - n + 2)) as s from texts, sizes where len(w) >= n),
        hits as (
            select row, s, p.n, item_id
            from places p join windows x on p.n = x.n and array_to_string(w[s:s + p.n - 1], ' ') = x.words),
        marked as (select distinct row, unnest(range(s, s + n)) as i from hits),
        counted as (select row, count(*) as n_hit from marked group by row),
        listed as (
            select row, count(distinct item_id) as n_items,
                   string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
            from hits group by row)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from texts left join counted using (row) left join listed using (row)""",
    "op13_collocations": r"""
        with texts as (
            select coalesce(lang, 'und') as lang,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents where text is not null),
        pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
        lists as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
        totals as (select lang, cast(sum(len(w)) as bigint) as n from lists group by lang),
        places as (
            select lang, w, k, unnest(range(1, len(w) - k + 2)) as s
            from lists, (values (1), (2), (3), (4)) lengths(k) where len(w) >= k),
        counts as (
            select lang, k, array_to_string(w[s:s + k - 1], ' ') as phrase, count(*) as f
            from places group by all having count(*) >= 30),
        cuts as (
            select lang, phrase, k, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as cut
            from counts where k > 1),
        scores as (
            select c.lang, c.phrase, a, cut, x.f as l, y.f as r,
                   cast(2000000 * a::hugeint // (x.f::hugeint + y.f) as bigint) as score
            from cuts c
            join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:cut], ' ')
            join counts y on y.lang = c.lang and y.phrase = array_to_string(w[cut + 1:], ' ')),
        lowest as (
            select * from scores
            qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        longer as (
            select distinct lang, array_to_string(string_split(phrase, ' ')[i:j], ' ') as phrase, f
            from counts, range(1, 5) a(i), range(1, 5) b(j)
            where i <= j and j <= k and j - i + 1 < k),
        kept as (
            select * from lowest c
            where not exists (
                from longer d where d.lang = c.lang and d.phrase = c.phrase and 100 * d.f::hugeint >= 80 * a::hugeint))
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
               phrase, a, l, r, n, score
        from kept join totals using (lang)
        qualify rank <= 2000""",
}
