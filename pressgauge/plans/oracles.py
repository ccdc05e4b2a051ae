"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from pressgauge.operators.pooling import Attention
from pressgauge.operators.tweets import EXCLUDED_HOSTS
from pressgauge.plans.fixtures import EPOCH, SENTENCES, VOCABULARY, WIDTH, WORDS

_PUNCT = r"[[:punct:]\s\x0b\x1c-\x1f\x85\pZ]+"
_SPACE = r"[^\s\x0b\x1c-\x1f\x85\pZ]+"
_WORD = r"""[^!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n ]+"""


def _parse(text: str) -> str:
    """Counter text to bigint."""
    branches = " ".join(
        f"when contains({text}, '{s}') then cast(trunc(try_cast(replace({text}, '{s}', '') as double) * {f}) as bigint)"
        for s, f in (("K", "1e3"), ("k", "1e3"), ("M", "1e6"), ("m", "1e6"), ("B", "1e9"), ("b", "1e9"))
    )
    return f"case when {text} = '' then 0 {branches} else try_cast({text} as bigint) end"


def _attention(vector: str, a: Attention) -> str:
    """Attention score of a list column."""
    units = []
    for k, (b, u) in enumerate(zip(a.b, a.u)):
        column = ", ".join(repr(float(row[k])) for row in a.w)
        units.append(f"tanh(list_dot_product({vector}, [{column}]::double[]) + {b!r}) * {u!r}")
    return "(" + " + ".join(units) + ")"


def _trim(title: str) -> str:
    return f"case when contains({title}, '-') then regexp_extract({title}, '(?s)^(.*)-', 1) else {title} end"


def _compound(s: str) -> str:
    return f"round({s} / sqrt({s} * {s} + 15), 4)"


def _unescape(text: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


_TITLE = rf"trim(regexp_replace({_unescape(r'''regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g')''')}, '\s+', ' ', 'g'))"

_CLEAN = r"""regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<nav\b[^>]*>.*?</nav>', ' ', 'g')"""
_LINES = r"""regexp_replace(regexp_replace(chosen, '(?i)</(?:p|div|h[1-6]|li|tr|blockquote)\s*>|<br\s*/?>|<p\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')"""
_BODY = rf"trim(regexp_replace(regexp_replace(trim(regexp_replace({_unescape(_LINES)}, '[ \t\r\f]+', ' ', 'g')), ' ?\n[ \n]*', chr(10), 'g'), '^\n+|\n+$', '', 'g'))"

VIEWS = {
    "v_titles": "select doc_id, lang, split_part(text, '.', 1) || ' - ' || source as title from documents",
    "v_tweets": """
        select c.conv_id as tweet_id, c.text, p.page_id, p.url as news_url,
               (c.conv_id * 13) % 700 as retweet_count, ((c.conv_id * 397) % 30) * 100 as favorite_count,
               'https://twitter.com/u' || cast(c.conv_id % 7 as varchar) || '/status/' || cast(c.conv_id as varchar) as tweet_url,
               case when c.conv_id % 5 = 0 then 'fr' else 'en' end as lang
        from conversations c join pages p
          on p.page_id = case when c.conv_id % 3 = 0 then 0 else c.conv_id // 4 end
        where c.turn = 0""",
    "v_like": f"""
        select conv_id as tweet_id, turn,
               case (conv_id * 7 + turn) % 6 when 0 then '' when 1 then '12' when 2 then '1.2K'
                    when 3 then '3m' when 4 then '1,234' else '7' end as like_str,
               text as comment,
               make_timestamp(({EPOCH} + (conv_id % 1440) * 60 + turn) * 1000000) as event_time
        from conversations where turn > 0""",
    "v_comments": f"""
        select *, 1 + coalesce({_parse('like_str')}, 0) as like_count,
               'https://twitter.com/u' || cast(tweet_id % 7 as varchar) || '/status/' || cast(tweet_id as varchar) as tweet_url,
               strftime(event_time, '%Y-%m-%d %H:%M:%S') as comment_time
        from v_like""",
    "v_tok": "select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from documents where lang = 'en'",
    "v_vocab": f"""
        select token, n, row_number() over (order by n desc, token) as idx
        from (select token, count(*) as n from v_tok where length(token) >= 3 group by token)
        qualify idx <= {VOCABULARY}""",
    "v_lexicon": "select token, cast(idx % 9 - 4 as double) as valence from v_vocab where idx <= 200",
    "v_modifiers": """
        select token, case when idx % 3 = 0 then 0.0 when idx % 2 = 0 then 0.293 else -0.293 end::double as boost,
               idx % 3 = 0 as negates
        from v_vocab where idx between 201 and 300""",
    "v_stop": "select token from v_vocab where idx <= 25",
    "v_lemma": """
        select token, case when token like '%s' then left(token, length(token) - 1) else token end as lemma
        from v_vocab where idx % 5 <> 0""",
    "v_pos": "select token, case idx % 4 when 0 then 'a' when 1 then 's' when 2 then 'n' else 'v' end as pos from v_vocab",
    "v_phrases": """
        select phrase from (
          select unnest(list_transform(range(1, len(t)), lambda k: t[k] || ' ' || t[k + 1])) as phrase
          from (select regexp_extract_all(lower(text), '[a-z]+') as t from documents where lang = 'en'))
        group by phrase order by count(*) desc, phrase limit 20""",
    "v_keywords": """
        select token as keyword from v_vocab where idx between 50 and 70
        union all select phrase from v_phrases""",
    "v_gazetteer": """
        select token as phrase, case idx % 3 when 0 then 'ORG' when 1 then 'GPE' else 'DATE' end as ent_type
        from v_vocab where idx between 100 and 200
        union all select phrase, 'EVENT' from v_phrases""",
    "v_hits": """
        select tweet_id, unnest(case when tweet_id % 2 = 0 then ['kw', 'alt'] else ['kw'] end) as news_keyword,
               retweet_count, favorite_count, tweet_url, news_url
        from v_tweets""",
    "v_seeds": """
        select sha256(news_url) as news_id, 'kw' as news_keyword, news_url, tweet_url, retweet_count, favorite_count
        from v_tweets
        qualify row_number() over (partition by news_url order by favorite_count desc, tweet_id) = 1""",
    "v_digits": """
        select cast(greatest(0, ceil(ln(greatest(count(*), 1) / 10.0) / ln(16.0))) as bigint) as digits from v_seeds""",
    "v_flat": f"""
        select tweet_id, created_at, strftime(ts, '%Y-%m-%d') as day, cast(hour(ts) as integer) as hour, lang,
               retweet_count + shift as retweet_count, favorite_count + shift as favorite_count, text,
               'https://twitter.com/u' || cast((tweet_id + shift) % 7 as varchar) || '/status/' || cast(tweet_id + shift as varchar) as tweet_url,
               case when tweet_id % 4 = 0 then null when shift > 0 and tweet_id % 2 = 0 then news_url || '#inner' else news_url end as news_url,
               tweet_id % 4 <> 0 as has_link
        from (select *, strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') as created_at
              from (select *, make_timestamp(({EPOCH} + tweet_id * 4321) * 1000000) as ts,
                           case when tweet_id % 3 = 0 then 1000 else 0 end as shift from v_tweets))""",
    "v_phrase_hits": """
        select distinct t.tweet_id, k.keyword as news_keyword
        from (select tweet_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ' ') || ' ' as padded from v_tweets) t
        join v_keywords k on contains(t.padded, ' ' || k.keyword || ' ')""",
    "v_ctok": """
        select tweet_id, turn, unnest(t) as token, generate_subscripts(t, 1) as pos
        from (select tweet_id, turn, regexp_extract_all(lower(comment), '[a-z]+') as t from v_comments)""",
    "v_scores": f"""
        select c.tweet_id, c.turn, {_compound('coalesce(s.total, 0.0)')} as score
        from v_comments c left join (
          select tweet_id, turn, sum(valence) as total from v_ctok join v_lexicon using (token) group by all) s
        using (tweet_id, turn)""",
    "v_weighted": """
        select tweet_id, count(*) as n_comments,
               round(cast(sum(cast(round(score * 10000) as bigint) * like_count) as double) / cast(sum(like_count) as double) / 10000, 6) as weighted_sentiment_score
        from v_scores join v_comments using (tweet_id, turn) group by tweet_id""",
    "v_dtok": """
        select doc_id, unnest(t) as token, generate_subscripts(t, 1) as pos
        from (select doc_id, regexp_extract_all(lower(text), '[a-z]+') as t from documents)""",
    "v_sent": """
        select doc_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as sent_pos
        from (select doc_id, string_split(text, '.') as s from documents)""",
    "v_words": f"""
        select doc_id, sent_pos, unnest(w) as token, generate_subscripts(w, 1) as pos
        from (select doc_id, sent_pos, regexp_extract_all(lower(sentence), '{_WORD}') as w from v_sent)""",
    "v_index": """
        select doc_id, cast(sent_pos as integer) as sent_pos,
               cast(row_number() over (partition by doc_id, sent_pos order by pos) - 1 as integer) as word_pos,
               cast(idx as integer) as idx
        from v_words join v_vocab using (token)""",
    "v_full": f"""
        select idx, token, embedding is not null as found,
               coalesce(embedding::double[], list_transform(range({WIDTH}), lambda x: 0.5::double)) as vector
        from v_vocab left join embeddings on vec_id = idx - 1""",
    "v_body": rf"""
        select page_id, url, {_TITLE} as news_title, {_BODY} as news_text, news_image
        from (select *, case when article <> '' then article when whole <> '' then whole else '' end as chosen
              from (select page_id, url, html, regexp_extract(clean, '(?is)<article\b[^>]*>(.*)</article>', 1) as article,
                           regexp_extract(clean, '(?is)<body\b[^>]*>(.*)</body>', 1) as whole,
                           regexp_extract(html, '(?is)<img\b[^>]*?\bsrc\s*=\s*["'']([^"'']*)["'']', 1) as news_image
                    from (select *, {_CLEAN} as clean from pages)))""",
    "v_articles": """select * from v_body where news_title <> '' and news_text <> ''""",
    "v_article_results": f"""
        select sha256(a.url) as news_id, any_value(a.news_title) as news_title, any_value(t.news_tokens) as news_tokens,
               string_agg(printf('%.4f', score), ',' order by sent_pos) as scores
        from v_articles a
        join (select page_id, string_agg(lemma, ' ' order by pos) as news_tokens
              from (select page_id, unnest(t) as token, generate_subscripts(t, 1) as pos
                    from (select page_id, regexp_extract_all(lower(news_text), '[a-z]+') as t from v_articles))
              join v_lemma using (token) where token not in (select token from v_stop) group by page_id) t using (page_id)
        join (select page_id, sent_pos, {_compound('coalesce(sum(valence), 0.0)')} as score
              from (select page_id, sent_pos, unnest(case when len(w) = 0 then [null] else w end) as token
                    from (select page_id, regexp_extract_all(lower(sentence), '[a-z]+') as w, sent_pos
                          from (select page_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as sent_pos
                                from (select page_id, string_split(news_text, '.') as s from v_articles))))
              left join v_lexicon using (token) group by page_id, sent_pos) x using (page_id)
        group by a.url""",
    "v_latest_day": """
        select user_id, strftime(ts, '%Y-%m-%d') as day, event_id, event_type, value from events
        qualify row_number() over (partition by user_id, strftime(ts, '%Y-%m-%d') order by ts desc, event_id desc) = 1""",
    "v_latest": """
        select user_id, event_id, event_type, value from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "v_doc_sent": f"""
        select doc_id, sent_pos, list(v order by dim) as vector from (
          select doc_id, sent_pos, dim, sum(e * x) / sum(e) as v from (
            select doc_id, sent_pos, dim, x, e from v_index
            join (select idx, exp({_attention('vector', WORDS)}) as e, unnest(vector) as x, unnest(range({WIDTH})) as dim from v_full) using (idx))
          group by all) group by all""",
}



def _article_link(url: str, *more: str) -> str:
    parts = " or ".join(f"contains({url}, '{part}')" for part in (*EXCLUDED_HOSTS, *more))
    return f"{url} is not null and not ({parts})"


_LINE_NODE = "case (k - 1) % 3 when 0 then 1 when 1 then 5 else 1501 end"

BODIES = {
    "weighted_sentiment": "select * from v_weighted",
    "comment_sentiment": "select * from v_scores",
    "sentence_sentiment": f"""
        select doc_id, cast(sent_pos as integer) as sent_pos, {_compound('coalesce(total, 0.0)')} as score
        from v_sent left join (
          select doc_id, sent_pos, sum(valence) as total
          from (select doc_id, sent_pos, unnest(regexp_extract_all(lower(sentence), '[a-z]+')) as token from v_sent)
          join v_lexicon using (token) group by all) using (doc_id, sent_pos)""",
    "emphasis_sentiment": f"""
        with w as (select tweet_id, turn, comment, regexp_extract_all(comment, '[A-Za-z]+') as t from v_comments),
        x as (select tweet_id, turn, unnest(t) as word, generate_subscripts(t, 1) as pos,
                     len(list_filter(t, lambda v: v <> upper(v))) > 0 as mixed from w),
        p as (select *, lower(word) as token, mixed and word = upper(word) and length(word) > 1 as caps,
                     lag(lower(word), 1) over o as p1, lag(lower(word), 2) over o as p2, lag(lower(word), 3) over o as p3
              from x window o as (partition by tweet_id, turn order by pos)),
        a as (select p.tweet_id, p.turn, case when coalesce(valence, 0) = 0 then 0.0 else
                (valence + sign(valence) * (case when caps then 0.733 else 0.0 end
                   + coalesce(m1.boost, 0) + 0.95::double * coalesce(m2.boost, 0) + 0.9::double * coalesce(m3.boost, 0)))
                * case when m1.negates then -0.74 else 1.0 end::double * case when m2.negates then -0.74 else 1.0 end::double
                * case when m3.negates then -0.74 else 1.0 end::double end as amount
              from p left join v_lexicon l on l.token = p.token left join v_modifiers m1 on m1.token = p1
              left join v_modifiers m2 on m2.token = p2 left join v_modifiers m3 on m3.token = p3),
        s as (select tweet_id, turn, sum(amount) as total from a group by all),
        f as (select tweet_id, turn, coalesce(total, 0.0) as total,
                     least(length(regexp_replace(comment, '[^!]', '', 'g')), 4) as excl,
                     length(regexp_replace(comment, '[^?]', '', 'g')) as ques
              from w left join s using (tweet_id, turn)),
        g as (select tweet_id, turn, total + sign(total) * (excl * 0.292::double
                + case when ques > 3 then 0.96 when ques > 1 then ques * 0.18 else 0.0 end::double) as total from f)
        select tweet_id, turn, {_compound('total')} as score from g""",
    "count_suffix_parse": f"""
        select tweet_id, turn, like_str, {_parse('like_str')} as parsed,
               {_parse("replace(like_str, ',', '')")} as parsed_plain, like_count from v_comments""",
    "thread_rollup": """
        select tweet_id, turn // 4 as part, cast(count(*) as integer) as n, string_agg(comment, '|' order by turn) as comments,
               string_agg(cast(like_count as varchar), ',' order by turn) as likes
        from v_comments group by tweet_id, turn // 4""",
    "thread_extract": f"""
        select cast(conv_id as varchar) || '/' || cast(turn as varchar) as tweet_url, k - 1 as position,
               case (k - 1) % 3 when 0 then '' when 1 then '4' else '1.5k' end as like_str,
               't' || cast(k - 1 as varchar) as comment_time, comment, cast({_LINE_NODE} as bigint) as like_count
        from (select conv_id, turn, unnest(s) as comment, generate_subscripts(s, 1) as k
              from (select conv_id, turn, string_split(text, chr(10)) as s from conversations))""",
    "comment_explode": """
        select news_id, tweet_url, turn as position, like_count, comment_time, comment
        from v_seeds join v_comments using (tweet_url) where length(comment) > 0""",
    "comment_explode_outer": """
        select news_id, tweet_url, turn as position, like_count
        from v_seeds left join (select * from v_comments where length(comment) > 0) using (tweet_url)""",
    "social_results": """
        with joined as (select s.*, c.turn, c.tweet_id, c.comment, c.like_count, c.comment_time, x.score
                        from v_seeds s join v_comments c using (tweet_url) join v_scores x using (tweet_id, turn)
                        where length(c.comment) > 0),
        lem as (select tweet_id, turn, count(*) as n,
                       string_agg(case when p.pos in ('a', 's') then lemma end, ' ' order by t.pos) as adj
                from v_ctok t join v_lemma using (token) left join v_pos p on p.token = lemma
                where t.token not in (select token from v_stop) group by all)
        select news_id, turn // 1000 as part, any_value(favorite_count) as favorite_count, cast(count(*) as integer) as n_comments,
               coalesce(string_agg(case when adj <> '' then adj end, ' ' order by turn), '') as tweets_tokens,
               string_agg(printf('%.4f', score), ',' order by turn) as scores,
               string_agg(cast(like_count as varchar), ',' order by turn) as likes,
               string_agg(comment_time, ',' order by turn) as comment_time,
               round(cast(sum(cast(round(score * 10000) as bigint) * like_count) as double) / cast(sum(like_count) as double) / 10000, 6) as weighted_sentiment_score
        from joined join lem using (tweet_id, turn) group by news_id, turn // 1000""",
    "group_max_favourites": "select news_url, tweet_url, max(favorite_count) as favorite_count from v_hits group by all",
    "keyword_sets": """
        select news_url, tweet_url, string_agg(news_keyword, ',' order by news_keyword) as news_keywords
        from (select distinct news_url, tweet_url, news_keyword from v_hits) group by all""",
    "latest_counts": "select * from v_latest",
    "title_trim": f"""
        select doc_id, {_trim('title')} as title,
               case when contains(head, '-') then regexp_extract(head, '(?s)^(.*)-', 1) else left(head, greatest(length(head) - 1, 0)) end as strict_title
        from (select *, split_part(title, ' - ', 1) as head from v_titles)""",
    "language_filter": f"select doc_id, {_trim('title')} as title from v_titles where lang = 'en'",
    "text_union": """
        select doc_id, 'title' as field, split_part(text, '.', 1) as line from documents
        union all select doc_id, 'description', source from documents
        union all select doc_id, 'content', text from documents""",
    "keyword_mining": """
        select distinct g.phrase as keyword
        from (select ' ' || array_to_string(regexp_extract_all(lower(title), '[a-z]+'), ' ') || ' ' as padded from v_titles) t
        join v_gazetteer g on contains(t.padded, ' ' || g.phrase || ' ')
        where ent_type in ('PERSON', 'NORP', 'FAC', 'ORG', 'GPE', 'PRODUCT', 'EVENT')""",
    "headline_runs": r"""
        select keyword, count(*) as n_titles from (
          select unnest(list_distinct(regexp_extract_all(title, '(?:^|[^\pL\pN])(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)', 1))) as keyword
          from v_titles) group by keyword having count(*) >= 2""",
    "keyword_search": "select * from v_phrase_hits",
    "tweet_flatten": "select * from v_flat",
    "tweet_hits": f"""
        select tweet_id, news_keyword, retweet_count, favorite_count, tweet_url, news_url
        from v_flat join v_phrase_hits using (tweet_id)
        where lang = 'en' and has_link and favorite_count >= 1000 and {_article_link('news_url')}""",
    "skewed_lookup": "select tweet_id, page_id, news_url from v_tweets",
    "url_exclusion": f"select page_id, url from pages where {_article_link('url', 'example.org')}",
    "engagement_threshold": "select tweet_id, favorite_count from v_tweets where favorite_count >= 1000",
    "pair_dedup": """
        select * from v_hits
        qualify row_number() over (partition by news_url, tweet_url order by tweet_id, news_keyword) = 1""",
    "top_tweet_per_url": """
        select * from v_hits
        qualify row_number() over (partition by news_url order by favorite_count desc, tweet_id, news_keyword) = 1""",
    "distinct_hits": "select distinct tweet_id, retweet_count, favorite_count, tweet_url, news_url from v_hits",
    "seed_table": """
        select sha256(news_url) as news_id, news_keyword, news_url, tweet_url, retweet_count, favorite_count
        from v_hits
        qualify row_number() over (partition by news_url order by favorite_count desc, tweet_id, news_keyword) = 1""",
    "record_encode": """
        select left(news_id, digits) as key, string_agg(news_id || ',' || news_keyword || ',' || news_url || ',' || tweet_url || ',' ||
               cast(retweet_count as varchar) || ',' || cast(favorite_count as varchar), ';' order by news_id) as value
        from v_seeds, v_digits group by all""",
    "record_decode": "select * from v_seeds",
    "record_quarantine": """
        select key, unnest(['short,record', 'n,k,u,t,x,1']) as record
        from (select distinct left(news_id, digits) as key from v_seeds, v_digits)""",
    "json_payload": "select news_id as key, news_keyword, tweet_url, retweet_count, favorite_count from v_seeds",
    "json_parse": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "letter_tokens": """
        select doc_id, cast(len(t) as integer) as n, array_to_string(t, ' ') as tokens
        from (select doc_id, regexp_extract_all(lower(text), '[a-z]+') as t from documents)""",
    "punct_tokens": rf"""
        select doc_id, array_to_string(t, '|') as tokens, cast(len(list_filter(t, lambda x: x <> '')) as integer) as n_kept
        from (select doc_id, regexp_split_to_array(lower(text), '{_PUNCT}') as t from documents)""",
    "word_sequence": rf"""
        select doc_id, array_to_string(regexp_extract_all(lower(text), '{_WORD}'), ' ') as words,
               cast(len(regexp_extract_all(text, '{_SPACE}')) as integer) as n_pieces from documents""",
    "flatten_tokens": """
        select conv_id, turn, array_to_string(flatten(list_transform(
                 list_filter(string_split(text, chr(10)), lambda l: length(l) > 60),
                 lambda l: regexp_extract_all(lower(l), '[a-z]+'))), ' ') as tokens
        from conversations""",
    "stopword_filter": """
        select doc_id, string_agg(token, ' ' order by pos) as tokens from v_dtok
        where token not in (select token from v_vocab where idx <= 40) group by doc_id""",
    "lemma_filter": """
        select doc_id, string_agg(lemma, ' ' order by pos) as tokens from v_dtok join v_lemma using (token) group by doc_id""",
    "lemma_rules": """
        with words as (select token as lemma from v_vocab where idx % 2 = 1),
        cand as (select token, 0 as rank, token as lemma from (select distinct token from v_dtok)
                 union all select token, 1, left(token, length(token) - 1) from (select distinct token from v_dtok) where token like '%s'
                 union all select token, 2, left(token, length(token) - 3) from (select distinct token from v_dtok) where token like '%ing'
                 union all select token, 3, left(token, length(token) - 2) from (select distinct token from v_dtok) where token like '%ed'),
        best as (select token, arg_min(lemma, rank) as lemma from cand join words using (lemma) group by token)
        select lemma as token, count(*) as n from v_dtok join best using (token) group by lemma""",
    "adjective_filter": """
        select tweet_id, turn, string_agg(token, ' ' order by t.pos) as tokens
        from v_ctok t join v_pos p using (token) where p.pos in ('a', 's') group by all""",
    "ml_tokens": """
        select doc_id, token, count(*) as n from v_dtok
        where token not in (select token from v_stop) group by all""",
    "term_counts": f"""
        select doc_id, token, count(*) as n from v_dtok
        where token in (select token from v_dtok group by token order by count(*) desc, token limit {VOCABULARY})
        group by all""",
    "vocabulary_topk": "select token, n, cast(idx as integer) as idx from v_vocab",
    "vocabulary_index": "select token, idx from v_vocab",
    "article_extract": "select page_id, news_title, news_text, news_image from v_articles",
    "article_join": """
        select news_id, news_title, cast(length(news_text) as integer) as n_chars from v_seeds left join v_body on url = news_url""",
    "article_results": "select * from v_article_results",
    "stream_articles": "select * from v_article_results",
    "document_merge": f"""
        with social as (select news_id, favorite_count, weighted_sentiment_score
                        from v_seeds join (select distinct tweet_id, tweet_url from v_comments) using (tweet_url)
                        join v_weighted using (tweet_id)),
        art as (select sha256(url) as news_id, {_TITLE} as news_title from pages)
        select coalesce(s.news_id, a.news_id) as news_id, cast(0 as bigint) as part, favorite_count, weighted_sentiment_score, news_title,
               case when s.news_id is null then date '2024-01-01' else date '2024-01-02' end as date
        from social s full outer join art a on s.news_id = a.news_id""",
    "stream_two_sides": """
        select coalesce(s.news_id, a.news_id) as news_id, s.favorite_count, a.n_chars,
               case when s.news_id is null then date '2024-01-01' else date '2024-01-02' end as date
        from v_seeds s full outer join (select sha256(url) as news_id, length(html) as n_chars from pages) a
          on s.news_id = a.news_id""",
    "doc_index_matrix": "select * from v_index",
    "doc_lengths": """
        select doc_id, count(*) as doc_length, cast(sum(n) as bigint) as n_words, max(n) as longest_sentence
        from (select doc_id, sent_pos, count(*) as n from v_index group by all) group by doc_id""",
    "padded_matrix": """
        select doc_id, cast(count(*) over (partition by doc_id) as integer) as doc_length, sent_pos,
               cast(max(n) over (partition by doc_id) as integer) as width,
               cast(n as integer) as length, ids
        from (select doc_id, sent_pos, count(*) as n, string_agg(cast(idx as varchar), ',' order by word_pos) as ids
              from v_index group by all)""",
    "label_join": """
        select doc_id, source, quality, cast(quality as varchar) || ',' || cast(1 - quality as varchar) as label_pair
        from documents join labels using (doc_id)""",
    "unlabelled_docs": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "vector_lookup": f"""
        select cast(idx as integer) as idx, token, found, cast(unnest(range({WIDTH})) as integer) as dim, round(unnest(vector), 6) as v from v_full""",
    "vector_sequence": """
        select doc_id, count(*) as n, round(cast(sum(cast(vector[1] as decimal(20,12)) * (word_pos + 1)) as double), 4) as s
        from v_index join v_full using (idx) group by doc_id""",
    "doc_vector": f"""
        select doc_id, cast(dim as integer) as dim, round(sum(e * x) / sum(e), 5) as v
        from (select doc_id, exp({_attention('vector', SENTENCES)}) as e, unnest(vector) as x, unnest(range({WIDTH})) as dim from v_doc_sent)
        group by all""",
    "attention_pool": f"""
        select label, cast(dim as integer) as dim, round(sum(e * x) / sum(e), 6) as v
        from (select label, exp({_attention('embedding::double[]', WORDS)}) as e, unnest(embedding::double[]) as x, unnest(range({WIDTH})) as dim from embeddings)
        group by all""",
    "attention_weights": f"""
        select vec_id, label, round(e / sum(e) over (partition by label), 8) as alpha
        from (select vec_id, label, exp({_attention('embedding::double[]', WORDS)}) as e from embeddings)""",
    "fold_assign": "select doc_id, cast(doc_id % 5 as integer) as fold from documents",
    "accuracy_loss": """
        select count(*) as n_docs, cast(sum(ok) as bigint) as n_correct, round(avg(ok), 6) as accuracy,
               round(-avg(quality * ln(p) + (1 - quality) * ln(1 - p)), 6) as loss
        from (select *, case when (p > 0.5) = (quality = 1) then 1 else 0 end as ok
              from (select quality, cast((((doc_id * 37) % 100) + 0.5) / 100 as double) as p from labels))""",
    "quality_report": f"""
        select 'label_rows' as "check", count(*) as value from labels
        union all select 'label_keys', count(distinct doc_id) from labels
        union all select 'label_not_binary', count(*) from labels where quality is null or quality not in (0, 1)
        union all select 'vocabulary_rows', count(*) from v_vocab
        union all select 'vocabulary_max_idx', max(idx) from v_vocab
        union all select 'vocabulary_idx_out_of_range', count(*) from v_vocab where idx not between 1 and {VOCABULARY}
        union all select 'link_rows', count(*) from pages
        union all select 'link_without_http', count(*) from pages where url is null or not contains(url, 'http')""",
    "stream_weighted_sentiment": "select * from v_weighted",
    "stream_dedup": "select tweet_id, turn, like_count from v_comments",
    "stream_latest": "select * from v_latest_day",
    "stream_upsert": "select * from v_latest",
    "source_roundtrip": """
        select 'lines' as format, regexp_replace(title, chr(10), ' ', 'g') as key, cast(count(*) as varchar) as value
        from v_titles group by all
        union all select 'csv', news_id, cast(favorite_count as varchar) from v_seeds
        union all select 'claims', cast(doc_id as varchar), case when quality = 1 then 'true' else 'false' end from labels
        union all select 'vectors', token, cast(len(embedding) as varchar) from v_vocab join embeddings on vec_id = idx - 1
        union all select 'json', cast(doc_id as varchar), cast(length(text) as varchar) from documents
        union all select 'day', cast(event_id as varchar), event_type from events
                  where cast(ts as date) = (select min(cast(ts as date)) from events)
        union all select 'days', cast(event_id as varchar), strftime(cast(ts as date), '%Y-%m-%d') from events""",
}

BODIES["stream_social"] = BODIES["social_results"]
BODIES["tweet_files"] = BODIES["tweet_flatten"]
BODIES["stream_messages"] = """
    select news_id, news_title, length(news_text) as n from v_seeds left join v_body on url = news_url
    union all select record, 'quarantined', count(*)
    from (select unnest(['short,record', 'n,k,u,t,x,1']) as record from (select distinct left(news_id, digits) from v_seeds, v_digits))
    group by record"""


def _needed(sql: str) -> list[str]:
    """Views a statement uses, dependencies first."""
    found: list[str] = []
    for name in re.findall(r"\bv_[a-z_]+\b", sql):
        if name in VIEWS and name not in found:
            for inner in _needed(VIEWS[name]):
                if inner not in found:
                    found.append(inner)
            if name not in found:
                found.append(name)
    return found


def _statement(body: str) -> str:
    views = [f"{name} as ({VIEWS[name]})" for name in _needed(body)]
    body = body.strip()
    for head in ("with recursive ", "with "):
        if views and body.startswith(head):
            return head + ",\n".join(views) + ",\n" + body[len(head):]
    return ("with " + ",\n".join(views) + "\n" if views else "") + body


ORACLES = {name: _statement(body) for name, body in BODIES.items()}
