"""The same results in plain SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from assayer.catalog.views import (
    EPOCHS_SQL,
    NOISY_RULE,
    PRED_SQL,
    REC_COLUMNS,
    REC_SQL,
    SCORES,
    SERVER_SQL,
)
from assayer.labels import LABELS as LABEL_NAMES

# The label set, as a table.
LABELS = (
    "(values (0, 'Read'), (1, 'Write'), (2, 'Execute'), (3, 'Destructive'),"
    " (4, 'Financial'), (5, 'Other')) as l(label_id, label)"
)
SPLITS = "(values (0, 'train'), (1, 'validation'), (2, 'test')) as s(ord, split)"

_WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def blank(c: str) -> str:
    return f"(coalesce({strip(c)}, '') = '')"


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def norm(c: str) -> str:
    return f"lower({collapse(f'coalesce({c}, {chr(39) * 2})')})"


HASH = f"sha1({norm('name')} || '||' || {norm('description')})"
NAME = f"case when {blank('name')} then 'unknown_tool' else {strip('name')} end"
DESCRIPTION = (
    f"case when {blank('description')} then '(no description provided)'"
    f" else substr({collapse('description')}, 1, 900) end"
)
IS_OBJECT = "coalesce(case when json_valid({c}) then json_type({c}) = 'OBJECT' end, false)"


def is_object(c: str) -> str:
    return IS_OBJECT.format(c=c)


def unparsable(c: str) -> str:
    return f"(not {blank(c)} and not {is_object(c)})"


def _shown(v: str) -> str:
    return (
        f"case coalesce(json_type({v}), 'NULL') when 'VARCHAR' then {v}->>'$'"
        f" when 'NULL' then 'None' when 'BOOLEAN' then"
        f" (case when cast({v} as varchar) = 'true' then 'True' else 'False' end)"
        f" when 'DOUBLE' then cast(cast({v} as double) as varchar)"
        f" else cast({v} as varchar) end"
    )


def params_ctes(source: str) -> str:
    """CTEs from ``source(record_id, input_schema)`` to ``params`` and ``shown``."""
    return f"""
    entries as (
      select record_id, input_schema,
        unnest(json_keys(input_schema, '$.properties')) as param,
        generate_subscripts(json_keys(input_schema, '$.properties'), 1) - 1 as position,
        len(json_keys(input_schema, '$.properties')) as n_params
      from (select * from {source} where {is_object('input_schema')})
      where json_type(input_schema, '$.properties') = 'OBJECT'),
    specs as (
      select *, json_extract(input_schema, '$.properties."' || param || '"') as spec from entries),
    params as (
      select *, json_type(spec) = 'OBJECT' as is_object,
        case when json_type(spec) <> 'OBJECT' then null
          when coalesce(json_type(spec, '$.type'), 'NULL') = 'NULL' then
            case when json_exists(spec, '$.enum') then 'enum'
              when json_exists(spec, '$.oneOf') or json_exists(spec, '$.anyOf') then 'union'
              else 'any' end
          when json_type(spec, '$.type') = 'ARRAY' then
            array_to_string(list_transform(json_extract(spec, '$.type[*]'), lambda v: {_shown('v')}), '|')
          else spec->>'$.type' end as type_hint,
        coalesce(list_contains(case when json_type(input_schema, '$.required') = 'ARRAY'
          then json_extract_string(input_schema, '$.required[*]') end, param), false) as required,
        case when json_type(spec) = 'OBJECT' and json_type(spec, '$.enum') = 'ARRAY'
            and json_array_length(spec, '$.enum') > 0 then
          array_to_string(list_transform(json_extract(spec, '$.enum[*]')[1:6], lambda v: {_shown('v')}), ', ')
          end as enum_preview,
        case when json_type(spec) = 'OBJECT' and json_type(spec, '$.description') = 'VARCHAR'
            and not {blank("(spec->>'$.description')")} then
          substr({collapse("(spec->>'$.description')")}, 1, 140) end as param_description
      from specs),
    lines as (
      select *, '- ' || param || ' (' || coalesce(type_hint || ', ', '')
        || case when required then 'required' else 'optional' end || ')'
        || coalesce(' enum[' || enum_preview || ']', '')
        || coalesce(': ' || param_description, '') as line
      from params),
    shown as (
      select record_id, position, line, false as is_overflow from lines where position < 12
      union all
      select distinct record_id, 12, '- ... and ' || cast(n_params - 12 as varchar)
        || ' more parameter(s)', true from lines where n_params > 12)"""


REC = f"rec as ({REC_SQL})"
PRED = f"pred as ({PRED_SQL})"
SERVER = f"server as ({SERVER_SQL})"
PARAMS = f"{REC}, {params_ctes('rec')}"
TEXTS = f"""{PARAMS},
    rendered as (
      select record_id, string_agg(line, chr(10) order by position) as listing
      from shown group by record_id),
    texts as (
      select rec.*, case when {blank('input_schema')} then 'no parameters'
          when not {is_object('input_schema')} then 'unparsable schema'
          else coalesce(listing, 'no parameters') end as params_text,
        'Tool name: ' || {NAME} || chr(10) || 'Description: ' || {DESCRIPTION} || chr(10)
          || 'Parameters:' || chr(10) || params_text as input_text
      from rec left join rendered using (record_id))"""

HASHED = f"{REC}, hashed as (select *, {HASH} as content_hash from rec)"


def noisy(where: str = "true") -> str:
    columns = ", ".join(f"{e} as {n}" for n, e in REC_COLUMNS.items())
    return (
        f"noisy as (select * from (select {columns}, {NOISY_RULE} as predicted_category"
        f" from documents) t where {where})"
    )


def class_ctes(source: str, true: str = "category", pred: str = "predicted_category") -> str:
    """CTE ``per_class`` over the fixed label set."""
    return f"""
    per_class as (
      select label_id, label, support, predicted,
        case when predicted > 0 then hit / predicted else 0.0 end as precision,
        case when support > 0 then hit / support else 0.0 end as recall,
        case when predicted + support > 0 then 2.0 * hit / (predicted + support) else 0.0 end as f1
      from (select l.label_id, l.label,
          count(*) filter (where {true} = l.label) as support,
          count(*) filter (where {pred} = l.label) as predicted,
          cast(count(*) filter (where {true} = l.label and {pred} = l.label) as double) as hit
        from {LABELS} left join {source} on {true} = l.label or {pred} = l.label
        group by l.label_id, l.label))"""


def overlap_sql(source: str, key: str) -> str:
    return f"""select a.split || '_vs_' || b.split as pair,
      (select count(*) from (select distinct {key} from {source} where split = a.split
         intersect select distinct {key} from {source} where split = b.split)) as overlap
      from {SPLITS.replace('as s(', 'as a(')} join {SPLITS.replace('as s(', 'as b(')}
      on a.ord < b.ord"""


def shared_sql(source: str, key: str) -> str:
    return f"""select a.split || '_vs_' || b.split as pair, a.{key}
      from (select distinct split, ord, {key} from {source} join {SPLITS} using (split)) a
      join (select distinct split, ord, {key} from {source} join {SPLITS} using (split)) b
      on a.{key} = b.{key} and a.ord < b.ord"""


TOKENS = """
    toks as (
      select doc_id as record_id,
        regexp_extract_all(strip_accents(lower(text)), '[0-9a-zß_]{2,}') as t from documents),
    grams as (
      select record_id, t, list_concat(t, list_transform(range(1, len(t)),
        lambda i: t[i] || ' ' || t[i + 1])) as terms from toks),
    tf as (
      select record_id, term, count(*) as n
      from (select record_id, unnest(terms) as term from grams) group by record_id, term),
    freq as (select term, count(*) as df from tf group by term),
    vocab as (
      select term, df, ln((1.0 + total) / (1.0 + df)) + 1.0 as idf
      from freq, (select count(*) as total from documents) where df >= 2 and df <= 0.9 * total)"""

_STATS = """
      coalesce(min(length(description)), 0) as description_chars_min,
      coalesce(max(length(description)), 0) as description_chars_max,
      round(coalesce(avg(length(description)), 0), 6) as description_chars_mean,
      coalesce(min(length(input_text)), 0) as input_text_chars_min,
      coalesce(max(length(input_text)), 0) as input_text_chars_max,
      round(coalesce(avg(length(input_text)), 0), 6) as input_text_chars_mean"""

_SCORE_LIST = f"[{', '.join(SCORES)}]"
_ARGMAX = f"list_position({_SCORE_LIST}, list_max({_SCORE_LIST})) - 1"
_INPUT_ARGMAX = _ARGMAX.replace("(text)", "(input_text)")
_COUNTS = ", ".join(f"c{i}" for i in range(len(LABEL_NAMES)))
_ONE_DECIMAL = "cast(printf('%.1f', {x}) as double)"
_REC_NO_TEXT = ", ".join(f"{e} as {n}" for n, e in REC_COLUMNS.items())

_ERRORS = f"{PRED}, err as (select * from pred where predicted_category is distinct from category)"
_TOP = f"""{_ERRORS},
    top as (
      select category as true_category, predicted_category, count(*) as n, min(ordinal) as first_seen
      from err group by 1, 2 order by n desc, first_seen limit 10)"""

ORACLE: dict[str, str] = {
    # --- sources, projections, predicates
    "load_records": f"with {REC} select ordinal, record_id, server_slug,"
    " case when name = '   ' then '' else name end as name, description, input_schema, category from rec",
    "labelled_filter": f"with {REC} select record_id, split, category from rec where category is not null",
    "blank_predicate": f"with {REC} select record_id, {blank('name')} as blank_name,"
    f" {blank('description')} as blank_description, {blank('input_schema')} as blank_input_schema from rec",
    "json_object_predicate": f"with {REC} select 'record' as origin, record_id,"
    f" {is_object('input_schema')} as is_object, {unparsable('input_schema')} as is_unparsable from rec"
    f" union all select 'event', cast(event_id as varchar), {is_object('props')}, {unparsable('props')}"
    " from events",
    "correct_flag": f"with {PRED} select record_id, category, predicted_category,"
    " predicted_category is not distinct from category as correct from pred",
    "error_filter": f"with {_ERRORS} select record_id, category, predicted_category from err",
    "valid_label_guard": f"with {noisy()} select record_id, predicted_category from noisy"
    f" where predicted_category not in (select label from {LABELS})",
    "leakage_column_drop": f"with {TEXTS} select record_id, input_text as text,"
    f" cast(label_id as bigint) as label_id from texts join {LABELS} on category = label",
    "label_encode": f"with {REC} select record_id, category, cast(label_id as bigint) as label_id"
    f" from rec left join {LABELS} on category = label",
    "label_decode": f"with {PRED} select record_id, cast(label_id as bigint) as label_id, label"
    f" from pred left join {LABELS} on predicted_category = label",
    "feature_projection": f"with {TEXTS} select record_id, input_text as text from texts",
    # --- text
    "whitespace_normalize": f"with {REC} select record_id, {collapse('description')} as description from rec",
    "norm_text": f"with {REC} select record_id, {norm('name')} as name,"
    f" {norm('description')} as description from rec",
    "content_hash": f"with {HASHED} select record_id, content_hash from hashed",
    "truncate_chars": f"with {REC} select record_id, substr(description, 1, 900) as first_900,"
    " substr(description, 1, 400) as first_400, substr(description, 1, 140) as first_140 from rec",
    "default_text": f"with {REC} select record_id, {NAME} as name, {DESCRIPTION} as description from rec",
    "char_length": f"with {TEXTS} select record_id, length(description) as description_chars,"
    " length(input_text) as input_text_chars from texts",
    "label_word_match": f"""with {SERVER} select ordinal, slug,
      coalesce((select string_agg(lower(label), ',' order by label_id) from {LABELS}
        where contains(lower(name || ' ' || description), lower(label))), '') as matched from server""",
    "pair_key": f"with {PRED} select record_id, category || '_to_' || coalesce(predicted_category, 'None') as pair from pred",
    "input_text": f"with {TEXTS} select record_id, input_text from texts",
    # --- parameter table
    "params_explode": f"""with {PARAMS}
      select 'record' as origin, record_id, position, param from params
      union all
      select 'event', cast(event_id as varchar), i - 1, json_keys(props)[i]
      from (select *, unnest(range(1, len(json_keys(props)) + 1)) as i from events)""",
    "param_type_hint": f"with {PARAMS} select record_id, position, is_object, type_hint from params",
    "param_required": f"with {PARAMS} select record_id, position, param, required from params",
    "param_enum_preview": f"""with {PARAMS}
      select 'record' as origin, record_id, position, enum_preview from params
      union all
      select 'part', cast(p_partkey as varchar), 0,
        p_brand || ', ' || p_type || ', ' || cast(p_size as varchar) || ', None, False, 1' from part""",
    "param_description": f"with {PARAMS} select record_id, position, param_description from params",
    "param_cap": f"with {PARAMS} select record_id, cast(position as bigint) as position, is_overflow from shown",
    "param_line": f"with {PARAMS} select record_id, cast(position as bigint) as position, line from shown",
    "params_render": f"with {TEXTS} select record_id, params_text from texts",
    # --- numbers
    "share_pct": f"""with {REC}, c as (
        select split, category, count(*) as n from rec where category is not null group by 1, 2)
      select split, category, n,
        {_ONE_DECIMAL.format(x="cast(n as double) / sum(n) over (partition by split) * 100.0")} as pct
      from c""",
    "round_mean_1dp": f"""with {REC} select server_slug,
        {_ONE_DECIMAL.format(x="cast(sum(length(description)) as double) / count(*)")} as mean_1dp
      from rec group by 1""",
    "power_dampen": f"""with {REC}, c as (select server_slug, cast(count(*) as double) as n from rec group by 1)
      select server_slug, round(pow(n, 0.0), 6) as pow_0, round(pow(n, 0.5), 6) as pow_half,
        round(pow(n, 1.0), 6) as pow_1 from c""",
    # --- joins and set operations
    "attach_predictions": f"with {noisy()} select record_id, server_slug, category, predicted_category from noisy",
    "split_pairs": f"""with {REC}, present as (
        select distinct split, ord from rec join {SPLITS} using (split))
      select a.split as split_a, b.split as split_b, a.split || '_vs_' || b.split as pair
      from present a join present b on a.ord < b.ord""",
    "group_overlap": f"with {REC} {overlap_sql('rec', 'server_slug')}",
    "content_overlap": f"with {HASHED} {overlap_sql('hashed', 'content_hash')}",
    "lookalike_rows": f"""with {HASHED} select record_id, split, exists (
        select 1 from hashed t where t.split = 'train' and t.content_hash = h.content_hash) as lookalike
      from hashed h where split <> 'train'""",
    "label_lookup": f"with {PRED} select record_id, cast(label_id as bigint) as label_id"
    f" from pred left join {LABELS} on predicted_category = label",
    "union_splits": f"with {REC} select record_id, split, server_slug, category from rec",
    "group_intersect": f"""with {REC}, redrawn as (
        select server_slug, case when ordinal % 3 = 0 then 'train' else split end as split from rec)
      {shared_sql('redrawn', 'server_slug')}""",
    "content_intersect": f"with {HASHED} {shared_sql('hashed', 'content_hash')}",
    "distinct_keys": f"with {HASHED} select distinct split, content_hash from hashed",
    # --- audit
    "split_rows": f"with {REC} select split, count(*) as rows from rec group by 1",
    "label_counts": f"with {REC} select split, category, count(*) as n from rec"
    " where category is not null group by 1, 2",
    "missing_counts": f"""with {REC} select split, count(*) filter (where {blank('name')}) as missing_name,
      count(*) filter (where {blank('description')}) as missing_description,
      count(*) filter (where {blank('input_schema')}) as empty_schema from rec group by 1""",
    "unparsable_count": f"with {REC} select split, count(*) filter (where {unparsable('input_schema')})"
    " as unparsable_schema from rec group by 1",
    "duplicate_ids": f"with {REC} select split, count(*) - count(distinct length(description))"
    " as duplicate_record_ids from rec group by 1",
    "exact_duplicates": f"with {HASHED} select split, count(*) - count(distinct content_hash)"
    " as exact_duplicates from hashed group by 1",
    "distinct_groups": f"with {REC} select split, count(distinct server_slug) as servers from rec group by 1",
    "length_stats": f"with {TEXTS} select split, {_STATS} from texts group by 1",
    "audit_split": f"""with {TEXTS} select split, count(*) as rows,
      count(distinct server_slug) as servers,
      count(*) filter (where {blank('name')}) as missing_name,
      count(*) filter (where {blank('description')}) as missing_description,
      count(*) filter (where {blank('input_schema')}) as empty_schema,
      count(*) filter (where {unparsable('input_schema')}) as unparsable_schema,
      count(*) - count(distinct record_id) as duplicate_record_ids,
      count(*) - count(distinct {HASH}) as exact_duplicates, {_STATS}
      from texts group by 1""",
    "label_share": f"""with {REC}, c as (
        select label_id, label, count(*) filter (where split = 'train') as train_n,
          count(*) filter (where split = 'validation') as validation_n,
          count(*) filter (where split = 'test') as test_n
        from {LABELS} left join rec on category = label group by 1, 2)
      select cast(label_id as bigint) as label_id, label, train_n, validation_n, test_n,
        {', '.join(
            f'''case when sum({s}_n) over () > 0 then
              {_ONE_DECIMAL.format(x=f"cast({s}_n as double) / sum({s}_n) over () * 100.0")} end as {s}_pct'''
            for s in ("train", "validation", "test"))}
      from c""",
    "imbalance_ratio": f"""with {REC}, c as (
        select split, category, count(*) as n from rec where category is not null group by 1, 2)
      select split, round(cast(max(n) as double) / min(n), 6) as imbalance_ratio from c group by 1""",
    "rare_share": f"""with {REC}, c as (
        select split, category, count(*) as n from rec where category is not null group by 1, 2),
      r as (select *, row_number() over (partition by split order by n, label_id) as k
        from c join {LABELS} on category = label)
      select split, round(cast(sum(n) filter (where k <= 2) as double) / sum(n) * 100.0, 6) as rare_pct
      from r group by 1""",
    "label_word_scan": f"""with {SERVER} select count(*) as rows_scanned, count(*) filter (where
        regexp_matches(lower(name || ' ' || description), 'read|write|execute|destructive|financial|other'))
        as rows_with_label_word from server""",
    "first_hits": f"""with {SERVER}, m as (select ordinal, slug,
        (select string_agg(lower(label), ',' order by label_id) from {LABELS}
         where contains(lower(name || ' ' || description), lower(label))) as matched from server)
      select * from m where matched is not null order by ordinal limit 10""",
    "sorted_groups": f"with {REC} select distinct split, server_slug from rec order by 1, 2",
    "length_sketch": f"""with {TEXTS}, lens as (
        select 'input_text_chars' as measure, length(input_text) as n, 900 as lim from texts
        union all
        select 'description_words', len(regexp_extract_all(lower(description), '[a-z0-9_]{{2,}}')), 320
        from texts)
      select measure, count(*) as rows,
        round(cast(count(*) filter (where n <= lim) as double) / count(*), 6) as share_within,
        true as p95_near, true as p99_near from lens group by measure""",
    "length_percentiles": f"""with {TEXTS}, lens as (
        select 'input_text_chars' as measure, length(input_text) as n, 900 as lim from texts
        union all
        select 'description_words', len(regexp_extract_all(lower(description), '[a-z0-9_]{{2,}}')), 320
        from texts)
      select measure, count(*) as rows, round(quantile_cont(n, 0.95), 6) as p95,
        round(quantile_cont(n, 0.99), 6) as p99,
        round(cast(count(*) filter (where n <= lim) as double) / count(*), 6) as share_within
      from lens group by measure""",
    # --- metrics
    "confusion_matrix": f"""with {PRED} select t.label as true_label, p.label as predicted_label,
        count(pred.record_id) as n
      from {LABELS.replace('as l(', 'as t(')} cross join {LABELS.replace('as l(', 'as p(')}
      left join pred on category = t.label and predicted_category = p.label group by 1, 2""",
    "per_class_metrics": f"""with {PRED}, {class_ctes('pred')}
      select cast(label_id as bigint) as label_id, label, round(precision, 6) as precision,
        round(recall, 6) as recall, round(f1, 6) as f1, support from per_class""",
    "accuracy": f"with {PRED} select count(*) as n_samples,"
    " round(avg(case when category = predicted_category then 1.0 else 0.0 end), 6) as accuracy from pred",
    "macro_f1": f"with {PRED}, {class_ctes('pred')} select round(avg(f1), 6) as macro_f1 from per_class",
    "weighted_f1": f"with {PRED}, {class_ctes('pred')}"
    " select round(sum(f1 * support) / sum(support), 6) as weighted_f1 from per_class",
    "macro_f1_present": f"with {PRED}, {class_ctes('pred')}"
    " select round(avg(f1), 6) as macro_f1_present from per_class where support + predicted > 0",
    "eval_report": f"""with {noisy('category is not null')}, {class_ctes('noisy')}
      select (select count(*) from noisy) as n_samples,
        round((select avg(case when category = predicted_category then 1.0 else 0.0 end) from noisy), 6)
          as accuracy,
        round(avg(f1), 6) as macro_f1, round(sum(f1 * support) / sum(support), 6) as weighted_f1,
        (select count(*) from noisy where predicted_category in (select label from {LABELS})) as in_matrix
      from per_class""",
    "class_weights": f"""with {REC}, train as (select * from rec where split = 'train'),
      c as (select label_id, label, count(train.record_id) as n
        from {LABELS} left join train on category = label group by 1, 2)
      select cast(label_id as bigint) as label_id, label, power, n,
        round(pow((select count(*) from train) / (6.0 * greatest(n, 1)), power), 6) as weight
      from c, (select unnest([0.0::double, 0.5::double, 1.0::double]) as power)""",
    "balanced_weights": f"""with {REC}, c as (
        select category, count(*) as n from rec where split = 'train' and category is not null group by 1)
      select cast(label_id as bigint) as label_id, label, n,
        round(cast(sum(n) over () as double) / (count(*) over () * n), 6) as weight
      from c join {LABELS} on category = label""",
    "confusion_pairs": f"with {_ERRORS} select category as true_category, predicted_category,"
    " count(*) as n, min(ordinal) as first_seen from err group by 1, 2",
    "error_rate": f"""with {PRED} select count(*) as rows,
        count(*) filter (where category is distinct from predicted_category) as errors,
        round(cast(errors as double) / count(*) * 100.0, 6) as error_pct from pred""",
    "invalid_rate": f"""with {noisy()} select count(*) as n,
        count(*) filter (where predicted_category not in (select label from {LABELS})) as invalid,
        round(cast(invalid as double) / count(*), 6) as invalid_rate from noisy""",
    "model_compare": f"""with {PRED},
      other as (select * from (select {_REC_NO_TEXT}, {_ARGMAX} as label_id from documents) t
        join {LABELS} using (label_id) where category is not null),
      a_class as (with {class_ctes('pred').strip()} select * from per_class),
      b_class as (with {class_ctes('other', pred='other.label').strip()} select * from per_class),
      vals as (
        select 'accuracy' as metric,
          (select avg(case when category = predicted_category then 1.0 else 0.0 end) from pred) as rule,
          (select avg(case when category = label then 1.0 else 0.0 end) from other) as counts
        union all select 'macro_f1', (select avg(f1) from a_class), (select avg(f1) from b_class)
        union all select 'weighted_f1', (select sum(f1 * support) / sum(support) from a_class),
          (select sum(f1 * support) / sum(support) from b_class)
        union all select 'errors', (select count(*)::double from pred where category is distinct from predicted_category),
          (select count(*)::double from other where category <> label))
      select metric, round(rule, 6) as rule, round(counts, 6) as counts, round(counts - rule, 6) as gap
      from vals""",
    # --- order-dependent
    "top_pairs": f"with {_TOP} select true_category || '_to_' || coalesce(predicted_category, 'None') as pair, * from top",
    "pair_examples": f"""with {_TOP}, ranked as (
        select true_category || '_to_' || coalesce(top.predicted_category, 'None') as pair, ordinal, record_id,
          server_slug, name, substr(description, 1, 400) as description,
          row_number() over (partition by true_category, top.predicted_category order by ordinal)
            as example_no
        from err join top on category = true_category
          and err.predicted_category is not distinct from top.predicted_category)
      select * from ranked where example_no <= 6""",
    "head_sample": f"with {REC} select ordinal, record_id, category from rec order by ordinal limit 100",
    "batched_scorer": f"select doc_id as record_id, label as predicted_category"
    f" from (select doc_id, {_ARGMAX} as label_id from documents) t join {LABELS} using (label_id)",
    "predict_job": f"""with {TEXTS}, s as (select record_id, {_INPUT_ARGMAX} as label_id from texts)
      select record_id, label as category from s join {LABELS} using (label_id)""",
    "group_stratified_split": f"""with {REC}, h as (
        select server_slug, {', '.join(f"count(*) filter (where category = '{label}') as c{i}" for i, label in enumerate(LABEL_NAMES))},
          count(*) as n from rec group by 1),
      g as (select server_slug, n, case when greatest({_COUNTS}) = 0 then -1
          else list_position([{_COUNTS}], greatest({_COUNTS})) - 1 end as stratum,
          substr(md5('20260801' || server_slug), 1, 3) as bucket from h),
      b as (select stratum, bucket, sum(n) as n from g group by 1, 2),
      p as (select stratum, bucket, (sum(n) over (partition by stratum order by bucket) - n / 2.0)
          / sum(n) over (partition by stratum) as spot from b)
      select server_slug, case when spot < 0.7 then 'train' when spot < 0.85 then 'validation' else 'test' end
        as split, cast(g.n as bigint) as rows from g join p using (stratum, bucket)""",
    "group_stratified_folds": f"""with recursive {REC}, h as (
        select server_slug, {', '.join(f"count(*) filter (where category = '{label}') as c{i}" for i, label in enumerate(LABEL_NAMES))},
          count(*) as n from rec group by 1),
      u as (select server_slug, n, [{', '.join(f"coalesce(c{i} / nullif(sum(c{i}) over (), 0), 0.0)" for i in range(len(LABEL_NAMES)))},
          n / sum(n) over ()] as v from h),
      o as (select *, row_number() over (order by list_sum(list_transform(v, lambda x: x * x)) desc,
          md5('20260714=' || server_slug)) as pos from u),
      walk as (select cast(0 as bigint) as pos, list_transform(range(0, 5), lambda s:
          list_transform(range(0, {len(LABEL_NAMES) + 1}), lambda l: cast(0 as double))) as held, cast(0 as bigint) as fold
        union all select pos, list_transform(range(1, 6), lambda s: case when s <> best then held[s]
          else list_transform(range(1, {len(LABEL_NAMES) + 2}), lambda l: held[s][l] + v[l]) end), best
        from (select pos, held, v, cast(list_position(costs, list_min(costs)) as bigint) as best from (
          select o.pos, held, v, list_transform(range(1, 6), lambda s: list_sum(list_transform(range(1, {len(LABEL_NAMES) + 2}),
            lambda l: v[l] * (2.0 * (held[s][l] - 0.2) + v[l]))) / 0.2) as costs
          from walk join o on o.pos = walk.pos + 1) a) b)
      select server_slug, cast(n as bigint) as rows, cast(walk.fold - 1 as integer) as fold from o join walk using (pos)""",
    "argmax_label": f"select cast(doc_id as varchar) as record_id, cast({_ARGMAX} as bigint) as label_id"
    " from documents",
    "best_epoch": f"""with e as ({EPOCHS_SQL}), r as (
        select *, row_number() over (partition by run order by macro_f1 desc, epoch) as k from e)
      select run, epoch as best_epoch, round(macro_f1, 6) as best_macro_f1 from r where k = 1""",
    "early_stop_epoch": f"""with e as ({EPOCHS_SQL}),
      a as (select *, row_number() over w as step, max(macro_f1) over (partition by run order by epoch
          rows between unbounded preceding and 1 preceding) as best_before
        from e window w as (partition by run order by epoch)),
      b as (select *, step - max(case when best_before is null or macro_f1 > best_before then step end)
          over (partition by run order by epoch rows unbounded preceding) as waited from a)
      select run, coalesce(min(epoch) filter (where waited >= 3), max(epoch)) as stop_epoch,
        bool_or(waited >= 3) as stopped_early from b group by run""",
    # --- features
    "tokens": f"with {TOKENS} select record_id, len(t) as n_tokens, array_to_string(t, ' ') as tokens from toks",
    "ngrams_1_2": f"with {TOKENS} select record_id, len(terms) as n_terms,"
    " array_to_string(terms, '|') as terms from grams",
    "doc_freq": f"with {TOKENS} select term, df from freq",
    "vocab_prune": f"with {TOKENS} select term, df, round(idf, 6) as idf from vocab",
    "tfidf": f"""with {TOKENS}, w as (
        select record_id, term, n, df, idf, (1.0 + ln(n)) * idf as weight from tf join vocab using (term))
      select record_id, term, n, df, round(idf, 6) as idf,
        round(weight / sqrt(sum(weight * weight) over (partition by record_id)), 6) as tfidf from w""",
}
