"""The registered queries as SQL for the checking engine (DuckDB).

Written as chains of common table expressions over the driver's tables. The text rules are put differently from
the Spark side wherever that is possible: list functions instead of regular expressions, the wrappers peeled
one by one, the tail trimmed with a list maximum.
"""

from __future__ import annotations

from masthead.sources.templates import load_templates
from masthead.workload.inputs import ARTICLE_VIEW, AS_OF
from masthead.workload.standin import FOREIGN, INVENTED, INVENTED_TOO, UNREADABLE

WS = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
DAY = 86400
MANY_WORDS = 14

# Fixed values, given here once more so that a slip in the library is seen.
STOPS = ("<|im_end|>", "Article:", "<|im_start|>")
TAIL_WORDS = """
    a an the of to in on at for with and or
    but as by when while after before that which
    who whose its his her their over under against
    amid despite during is are was were has have
    had will would could should may might been being
    from into about than because if so not no
    new other several various more most key top
    major latest former first last this these those
    such any all both each every few many some
""".split()
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
DATE_LEAD = rf"(?i)^on +({'|'.join(MONTHS)})[a-z]*[.]? +[0-9][0-9]?,? +[0-9]{{4}},? *"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def _words(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WS}+'), lambda x: x <> '')"


def _cut(expr: str) -> str:
    for stop in STOPS:
        expr = f"split_part({expr}, {_text(stop)}, 1)"
    return _strip(expr)


def _approves(headline: str, snippet: str = "snippet") -> str:
    words = f"list_distinct(regexp_extract_all(lower({headline}), '[a-z0-9]+'))"
    seen = f"list_distinct(regexp_extract_all(lower({snippet}), '[a-z0-9]+'))"
    return f"(len(list_intersect({words}, {seen})) * 10 >= len({words}) * 6)"


def _with(*steps: str, final: str) -> str:
    return "with " + ",\n".join(steps) + "\n" + final


_VIEW = (
    ARTICLE_VIEW.replace("{string}", "varchar")
    .replace("{documents}", "documents")
    .replace("{first_line}", "split_part(text, chr(10), 1)")
)
_ARTICLES = f"articles as ({_VIEW})"

_UNCHECKED = "(headline_verified = 0 or headline_verified is null)"
_PENDING = "rephrased_title is null and content is not null"
_UNVERIFIED = f"rephrased_title is not null and rephrased_title <> '' and {_UNCHECKED}"
_DAY = f"scraped_at >= {AS_OF - DAY}"
_DAYS = f"scraped_at >= {AS_OF - 3 * DAY}"
_NEWEST = "order by scraped_at desc, id desc"

_STATE = f"""case when {_PENDING} then 'pending' when rephrased_title = '' then 'parked'
  when {_UNVERIFIED} then 'unverified' when rephrased_title is not null then 'verified' end"""

_SKIP = r"""case when length(content) > 15000 then 'content too long'
  when contains(lower(t), 'live updates') or contains(lower(t), 'explained') or contains(lower(t), 'from a to z')
    then 'title phrase'
  when length(t) - length(replace(t, '|', '')) >= 2 then 'title pipes'
  when starts_with(content, 'Opinion') then 'opinion content'
  when contains(t, 'Opinion |') or contains(t, '| Comment') or contains(t, 'Editorial:') then 'opinion title' end"""
_SKIPPED = f"skipped as (select *, {_SKIP} as skip_reason from (select *, coalesce(title, '') as t from articles) x)"


def _clean(source: str, into: str) -> list[str]:
    """Steps from a table with columns ``id, kind, s`` to one with ``clean`` and ``reason`` added."""
    peeled = r"""case when regexp_matches(acc, '(?s)^(?:"(?:.*")?|''(?:.*'')?|\*(?:.*\*)?)$') then """
    peeled += _strip("case when length(acc) <= 2 then '' else substring(acc, 2, length(acc) - 2) end")
    peeled += " else acc end"
    leading = f"""length(regexp_extract(c, '^(?:["''*]|{WS})*'))"""
    count = f"len({_words('clean')})"
    reason = f"""case when {count} = 0 then 'empty headline' when {count} < 3 then 'too short'
      when {count} > {MANY_WORDS} then 'length ' || {count} || ' exceeds 14 words'
      when regexp_matches(clean, '[^\\P{{L}}\\x{{0}}-\\x{{24F}}]') then 'contains non-Latin script characters' end"""
    return [
        f"{into}_1 as (select *, {_strip('s')} as c from {source})",
        f"""{into}_2 as (select *, list_reduce(list_prepend(c, list_transform(range({leading}), lambda i: '')),
          lambda acc, z: {peeled}) as p from {into}_1)""",
        f"""{into}_3 as (select *, case when ends_with(p, '.') then {_strip('substring(p, 1, length(p) - 1)')}
          else p end as q from {into}_2)""",
        f"{into}_4 as (select *, {_strip(f'''regexp_replace(q, '{WS}+', ' ', 'g')''')} as r from {into}_3)",
        f"{into}_5 as (select id, kind, s, upper(substring(r, 1, 1)) || substring(r, 2) as clean from {into}_4)",
        f"{into} as (select *, {reason} as reason from {into}_5)",
    ]


def _lead(source: str, into: str) -> list[str]:
    """Steps from a table with columns ``id, content`` to one with ``lead``, not yet cleaned."""
    tails = "[" + ", ".join(map(_text, TAIL_WORDS)) + "]"
    weak = f"""list_contains({tails}, trim(lower(x), '.,;:"''')) or (ends_with(lower(x), 'ing') and i > 6)"""
    return [
        f"""{into}_1 as (select id, regexp_replace(trim(regexp_replace(content, '{WS}+', ' ', 'g')),
          '[*_`#]+', '', 'g') as x from {source})""",
        f"""{into}_2 as (select id, regexp_replace(case when regexp_matches(x, '[.!?] ')
          then regexp_extract(x, '^(.*?[.!?]) ', 1) else x end, {_text(DATE_LEAD)}, '') as x from {into}_1)""",
        f"{into}_3 as (select id, list_filter(string_split(x, ' '), lambda x: x <> '') as w from {into}_2)",
        f"{into}_4 as (select id, w, case when len(w) > {MANY_WORDS} then w[1:12] else w end as u from {into}_3)",
        f"""{into}_5 as (select id, w, u, coalesce(list_max(list_transform(u,
          lambda x, i: case when {weak} then 0 else i end)), 0) as keep from {into}_4)""",
        f"""{into} as (select id, rtrim(array_to_string(case when keep < 3 then w[1:12] else u[1:keep] end, ' '),
          '.,;: ') as lead from {into}_5)""",
    ]


# ---- the stand-in model ------------------------------------------------------------------------------

_ERROR = _text(f"ValueError: {UNREADABLE}")


def _answers(where: str) -> list[str]:
    """The stand-in's answers for the articles that match, and what the critic says of them."""
    hook = f"""case k % 9 when 0 then '"' || line || '"' when 1 then '**' || line || '**' when 2 then line || '.'
      when 3 then {_text(INVENTED)} when 4 then '' when 5 then {_text(FOREIGN)} || line
      when 6 then '''*' || line || '*''' when 7 then line || '<|im_end|>Article: {INVENTED}' else line end"""
    safe = f"""case k % 5 when 0 then {_text(INVENTED_TOO)} when 1 then '"' || line || '"'
      when 2 then '' when 3 then line else line || '.' end"""
    return [
        _ARTICLES,
        f"""seen as (select *, substring(content, 1, 1500) as snippet from articles where {where})""",
        """opened as (select *, length(snippet) - length(replace(snippet, 'a', '')) as k,
          trim(split_part(snippet, chr(10), 1)) as line from seen)""",
        f"""asked as (select *, k % 23 = 7 as hook_fails, k % 29 = 8 as safe_fails, k % 31 = 9 as critic_fails,
          {_cut(hook)} as hook, {_cut(safe)} as safe from opened)""",
        f"""answered as (select *, {_approves('hook')} as hook_ok, {_approves('safe')} as safe_ok from asked)""",
    ]


def _texts_and_leads(texts: str) -> list[str]:
    return [
        *_lead("answered", "leads"),
        f"texts as ({texts} union all select id, 'lead' as kind, lead as s from leads)",
        *_clean("texts", "cleaned"),
        "lead_texts as (select id, clean as lead from cleaned where kind = 'lead')",
    ]


def _generated(where: str = "true") -> list[str]:
    """Steps up to ``decided``, the decisions of a generation run over the matching articles."""
    return [
        *_answers(where),
        *_texts_and_leads(
            "select id, 'hook' as kind, hook as s from answered union all select id, 'safe', safe from answered"
        ),
        """ways as (select a.*, case when title is null then 'untitled' when hook_fails then 'hook fails'
            when hook <> '' and critic_fails then 'hook critic fails' when hook <> '' and hook_ok then 'hook'
            when safe_fails then 'safe fails' when safe = '' then 'safe empty'
            when critic_fails then 'safe critic fails' when safe_ok then 'safe' else 'safe refused' end as way,
          h.clean as hook_clean, h.reason as hook_reason, s.clean as safe_clean, s.reason as safe_reason, l.lead
          from answered a join cleaned h on h.id = a.id and h.kind = 'hook'
          join cleaned s on s.id = a.id and s.kind = 'safe' join lead_texts l on l.id = a.id)""",
        """formatted as (select *, case way when 'hook' then hook_clean when 'safe' then safe_clean end as clean,
            case way when 'hook' then hook_reason when 'safe' then safe_reason end as format_reason from ways)""",
        f"""decided as (select *,
            case when way in ('hook', 'safe') and format_reason is null then clean
              when way in ('hook', 'safe', 'safe empty', 'safe refused') then lead end as headline,
            case when way in ('hook', 'safe') and format_reason is null then 0
              when way in ('hook', 'safe', 'safe empty', 'safe refused') then 1 end as verified,
            case when way in ('hook', 'safe') then case when format_reason is null then way
              else 'format_fallback' end
              when way in ('safe empty', 'safe refused') then 'fallback' else 'error' end as outcome,
            case way when 'untitled' then 'load' when 'hook fails' then 'hook' when 'hook critic fails'
              then 'hook_critic' when 'hook' then 'hook_critic' when 'safe fails' then 'safe'
              when 'safe empty' then 'safe' else 'safe_critic' end as stage,
            case way when 'safe empty' then 'empty headline' when 'safe refused' then 'critic answered NO'
              else format_reason end as reason,
            case when way = 'untitled' then 'article has no title' when way like '%fails' then {_ERROR} end as error
          from formatted)""",
    ]


_GENERATION_REJECTIONS = """rejected as (
  select id, 'hook' as stage, hook as generated,
    case when hook = '' then 'empty headline' else 'critic answered NO' end as reason
    from decided where way not in ('untitled', 'hook fails', 'hook critic fails', 'hook')
  union all select id, 'safe', safe, reason from decided where way in ('safe empty', 'safe refused')
  union all select id, 'format', clean, format_reason from decided where format_reason is not null
  union all select id, 'load', '', 'unreadable text: ' || broken from decided where broken is not null)"""


def _audited(where: str = _UNVERIFIED) -> list[str]:
    """Steps up to ``decided``, the decisions of an audit run over the matching articles."""
    return [
        *_answers(where),
        *_texts_and_leads("select id, 'safe' as kind, safe as s from answered"),
        f"""repaired as (select a.*, s.clean as fixed, l.lead, {_approves('rephrased_title')} as published_ok,
            coalesce(s.reason, case when s.clean = rephrased_title then 'same as the refused headline' end) as doubt
          from answered a join cleaned s on s.id = a.id and s.kind = 'safe' join lead_texts l on l.id = a.id)""",
        f"""ways as (select *, case when critic_fails then 'critic fails' when published_ok then 'validated'
            when safe_fails then 'repair fails' when doubt is not null then 'doubt'
            when {_approves('fixed')} then 'fixed' else 'refused' end as way from repaired)""",
        f"""decided as (select *,
            case way when 'validated' then rephrased_title when 'fixed' then fixed when 'doubt' then lead
              when 'refused' then lead end as headline,
            case when way like '%fails' then null else 1 end as verified,
            case way when 'validated' then 'validated' when 'fixed' then 'fixed' when 'doubt' then 'fallback'
              when 'refused' then 'fallback' else 'error' end as outcome,
            case way when 'critic fails' then 'critic' when 'validated' then 'critic' when 'repair fails'
              then 'repair' when 'doubt' then 'repair' else 'repair_critic' end as stage,
            case way when 'doubt' then doubt when 'refused' then 'critic answered NO' end as reason,
            case when way like '%fails' then {_ERROR} end as error from ways)""",
    ]


_AUDIT_REJECTIONS = """rejected as (
  select id, 'published' as stage, rephrased_title as generated, 'critic answered NO' as reason
    from decided where way not in ('critic fails', 'validated')
  union all select id, 'repair', fixed, reason from decided where way in ('doubt', 'refused')
  union all select id, 'load', '', 'unreadable text: ' || broken from decided where broken is not null)"""

_DECISIONS = "select id, headline, verified, outcome, stage, reason, error from decided"
_UPDATED = """updated as (select a.id, a.scraped_at, a.content,
  case when d.outcome <> 'error' then d.headline else a.rephrased_title end as rephrased_title,
  case when d.outcome <> 'error' then d.verified else a.headline_verified end as headline_verified
  from articles a left join decided d on d.id = a.id)"""
_WAITING = f"{_DAY} and {_PENDING}"


def _render(template: str, **slots: str) -> str:
    pieces = _text(template)
    for slot, expr in slots.items():
        pieces = pieces.replace("{" + slot + "}", f"' || {expr} || '")
    return pieces


def _prompt(name: str) -> str:
    return _render(getattr(load_templates(), name), body_snippet="snippet", headline="raw")


def oracles() -> dict[str, str]:
    """Name -> SQL."""
    raw_texts = "texts as (select id, 'raw' as kind, raw as s from articles)"
    cleaned = [_ARTICLES, raw_texts, *_clean("texts", "cleaned")]
    counted = """select count(*) as loaded, count(*) filter (outcome in ('hook', 'safe')) as processed,
      count(*) filter (outcome in ('fallback', 'format_fallback')) as fallback,
      count(*) filter (outcome = 'error') as errors"""
    sql = {
        "pending_batch": _with(
            _ARTICLES, final=f"select id, scraped_at from articles where {_WAITING} {_NEWEST} limit 10"
        ),
        "pending_shard": _with(
            _ARTICLES,
            final=f"select id, scraped_at from articles where {_WAITING} and id % 4 = 1 {_NEWEST} limit 10",
        ),
        "newest_many": _with(_ARTICLES, final=f"select id, scraped_at from articles {_NEWEST} limit 12000"),
        "pending_all": _with(_ARTICLES, final=f"select id, scraped_at from articles where {_WAITING}"),
        "audit_batch": _with(
            _ARTICLES,
            final=f"""select id, scraped_at, rephrased_title from articles where {_DAYS} and {_UNVERIFIED}
              {_NEWEST} limit 20""",
        ),
        "audit_shard": _with(
            _ARTICLES,
            final=f"""select id, scraped_at, rephrased_title from articles where {_DAYS} and {_UNVERIFIED}
              and id % 4 = 1 {_NEWEST} limit 20""",
        ),
        "all_shards_topk": _with(
            _ARTICLES,
            final=f"""select id, id % 4 as shard, row_number() over (partition by id % 4 {_NEWEST}) as rn
              from articles where {_DAYS} and {_UNVERIFIED} qualify rn <= 20""",
        ),
        "headline_states": _with(
            _ARTICLES, final=f"select {_STATE} as state, count(*) as n from articles group by 1"
        ),
        "article_states": _with(_ARTICLES, final=f"select id, {_STATE} as state from articles"),
        "has_unverified": _with(
            _ARTICLES, final=f"select count(*) > 0 as has_more from articles where {_DAYS} and {_UNVERIFIED}"
        ),
        "skip_reasons": _with(_ARTICLES, _SKIPPED, final="select id, skip_reason from skipped"),
        "kept_articles": _with(_ARTICLES, _SKIPPED, final="select id from skipped where skip_reason is null"),
        "skip_counts": _with(
            _ARTICLES, _SKIPPED, final="select skip_reason, count(*) as n from skipped group by 1"
        ),
        "clean_headlines": _with(*cleaned, final="select id, clean from cleaned"),
        "format_check": _with(*cleaned, final="select id, reason is null as valid, reason from cleaned"),
        "format_check_raw": _with(
            _ARTICLES,
            "stripped as (select id, 'raw' as kind, raw as s, raw as clean from articles)",
            _clean("x", "checked")[-1].replace("checked_5", "stripped"),
            final="select id, reason is null as valid, reason from checked",
        ),
        "format_counts": _with(
            *cleaned,
            r"""kinds as (select a.lang, a.source,
              coalesce(regexp_replace(c.reason, '^length \d+ ', 'length '), 'valid') as reason
              from cleaned c join articles a on a.id = c.id)""",
            final="""select lang, source, (grouping(lang) + grouping(source))::bigint as level, reason,
                count(*)::bigint as n from kinds
              group by grouping sets ((reason, lang, source), (reason, lang), (reason))""",
        ),
        "lead_headlines": _with(
            _ARTICLES,
            *_lead("articles", "leads"),
            "texts as (select id, 'lead' as kind, lead as s from leads)",
            *_clean("texts", "cleaned"),
            final="select id, clean as headline from cleaned",
        ),
        "waiting_leads": _with(
            _ARTICLES,
            f"waiting as (select * from articles where {_WAITING})",
            *_lead("waiting", "leads"),
            "texts as (select id, 'lead' as kind, lead as s from leads)",
            *_clean("texts", "cleaned"),
            final="""select c.id, w.scraped_at, clean as headline, reason is null as valid, reason
              from cleaned c join waiting w on w.id = c.id""",
        ),
        "inflated_content": _with(
            _ARTICLES,
            final="""select id, length(content)::bigint as n_chars, md5(content) as content_md5,
              broken is not null as corrupt from articles""",
        ),
        "quarantine": _with(_ARTICLES, final="select id, broken as cause from articles where broken is not null"),
        "quarantine_counts": _with(
            _ARTICLES, final="select broken as cause, count(*) as n from articles where broken is not null group by 1"
        ),
        "snippets": _with(_ARTICLES, final="select id, substring(content, 1, 1500) as snippet from articles"),
        "prompts": _with(
            _ARTICLES,
            "seen as (select *, substring(content, 1, 1500) as snippet from articles)",
            final=f"""select id, md5({_prompt('hook')}) as hook_md5, md5({_prompt('safe')}) as safe_md5,
              md5({_prompt('critic')}) as critic_md5 from seen""",
        ),
        "stop_cut": _with(
            _ARTICLES,
            f"""answers as (select id, coalesce(' ' || raw || case id % 4
              when 0 then {_text(f'{STOPS[0]} {STOPS[1]}')} when 1 then {_text(f'{STOPS[2]}{STOPS[0]}')}
              when 2 then {_text(f' {STOPS[1]} {STOPS[2]}')} else '' end || title, raw) as answer from articles)""",
            final=f"select id, {_cut('answer')} as text from answers",
        ),
        "verdicts": _with(
            _ARTICLES,
            """answers as (select id, upper(coalesce(case when id % 2 = 0 then 'yes, ' else '' end || title, ''))
              as answer from articles)""",
            final="select id, contains(answer, 'YES') and not contains(answer, 'NO') as verdict from answers",
        ),
        "generate_standin": _with(
            *_answers("true"),
            final=f"""select id, case when not hook_fails then hook end as text,
              case when hook_fails then {_ERROR} end as error from answered""",
        ),
        "critic_standin": _with(
            *_answers("true"),
            final=f"""select id, not critic_fails and {_approves('raw')} as approved,
              case when critic_fails then {_ERROR} end as error from answered""",
        ),
        "generation_cascade": _with(*_generated(), final=_DECISIONS),
        "audit_cascade": _with(*_audited(), final=_DECISIONS),
        "updated_articles": _with(
            *_generated(_WAITING), _UPDATED, final="select id, rephrased_title, headline_verified from updated"
        ),
        "stored_articles": _with(
            *_generated(_WAITING),
            _UPDATED,
            final="select id, rephrased_title, headline_verified, scraped_at // 86400 as scraped_day from updated",
        ),
        "audited_articles": _with(
            *_audited(), _UPDATED, final="select id, rephrased_title, headline_verified from updated"
        ),
        "undecided_articles": _with(*_generated(), final="select id from decided where outcome = 'error'"),
        "rejected_texts": _with(*_generated(), _GENERATION_REJECTIONS, final="select * from rejected"),
        "rejected_repairs": _with(*_audited(), _AUDIT_REJECTIONS, final="select * from rejected"),
        "rejection_log": _with(
            *_generated(),
            _GENERATION_REJECTIONS,
            final="""select id, '[2024-01-08 00:00:00] Article ID: ' || id || ' | Stage: ' || stage
              || ' | Generated: ''' || generated || ''' | Reason: ' || reason as line from rejected""",
        ),
        "blanked_articles": _with(
            *_generated(),
            _GENERATION_REJECTIONS,
            final="""select id, case when id in (select id from rejected where stage = 'format') then ''
              else rephrased_title end as rephrased_title, headline_verified from articles""",
        ),
        "generation_counts": _with(
            *_generated(f"{_WAITING} and id in (select id from articles where {_WAITING} {_NEWEST} limit 10)"),
            final=counted + ", count(*) = 10 as has_more from decided",
        ),
        "generation_counts_all": _with(*_generated(_WAITING), final=counted + ", false as has_more from decided"),
        "generation_shard_counts": _with(
            *_generated(f"{_WAITING} qualify row_number() over (partition by id % 4 {_NEWEST}) <= 2"),
            final="""select shard, count(outcome) as loaded, count(*) filter (outcome in ('hook', 'safe')) as processed,
              count(*) filter (outcome in ('fallback', 'format_fallback')) as fallback,
              count(*) filter (outcome = 'error') as errors, count(outcome) = 2 as has_more
              from (select unnest(range(4)) as shard) s left join decided on id % 4 = shard group by shard""",
        ),
        "audit_shard_counts": _with(
            *_audited(f"{_DAYS} and {_UNVERIFIED} qualify row_number() over (partition by id % 4 {_NEWEST}) <= 2"),
            _UPDATED,
            f"""open as (select distinct id % 4 as left_shard from updated where {_DAYS} and {_UNVERIFIED})""",
            final="""select shard, count(outcome) as loaded, count(*) filter (outcome = 'validated') as validated,
              count(*) filter (outcome in ('fixed', 'fallback')) as fixed, count(*) filter (outcome = 'error') as llm_failures,
              count(*) filter (outcome <> 'error') > 0 and bool_or(left_shard is not null) as has_more
              from (select unnest(range(4)) as shard) s left join decided on id % 4 = shard
              left join open on left_shard = shard group by shard""",
        ),
        "side_by_side": _with(
            *_generated(_WAITING),
            _UPDATED,
            final="select id, rephrased_title, headline_verified, scraped_at // 86400 as scraped_day from updated",
        ),
        "audit_counts": _with(
            *_audited(f"{_DAYS} and {_UNVERIFIED}"),
            _UPDATED,
            final=f"""select count(*) as loaded, count(*) filter (outcome = 'validated') as validated,
              count(*) filter (outcome in ('fixed', 'fallback')) as fixed,
              count(*) filter (outcome = 'error') as llm_failures, count(*) filter (outcome <> 'error') > 0
                and (select count(*) > 0 from updated where {_DAYS} and {_UNVERIFIED}) as has_more
              from decided""",
        ),
        "outcome_counts": _with(
            *_generated(), final="select stage, outcome, count(*) as n from decided group by 1, 2"
        ),
        "audit_outcome_counts": _with(
            *_audited(), final="select stage, outcome, count(*) as n from decided group by 1, 2"
        ),
        "streamed_headlines": _with(
            *_generated(_WAITING), _UPDATED, final="select id, rephrased_title, headline_verified from updated"
        ),
        "streamed_decisions": _with(
            *_generated(_WAITING),
            final="""select id, headline, verified, outcome, case when outcome = 'error' then 2 else 1 end::bigint as times
              from decided""",
        ),
        "arrivals_once": _with(_ARTICLES, final="select id, 1::bigint as n from articles"),
        "still_waiting": _with(
            *_generated(_WAITING), _UPDATED, final=f"select id from updated where {_DAY} and {_PENDING}"
        ),
    }
    return sql
