"""JSON-Schema text to parameter descriptions, as native expressions.

The text is parsed once. It is wrapped as ``[text,{mark}]`` and read as an array of
structs. The mark holds the text's own SHA-1, which no text can contain, so the array has
exactly two elements, the first not null and the second the mark, if and only if the text is
one JSON object with nothing after it: a text that closes the array itself loses the mark. ``properties`` is a map because a
map keeps document order, and its values are variants because a variant keeps the JSON
type of each value.

The expressions are SQL text over column names: they nest deeply, and one parsed text
costs the driver a fraction of what the same tree costs when built call by call.

A key that a specification repeats keeps its last value if the session lets variants have such keys:
:func:`assayer.session.keep_last_of_repeated_keys`, which the operators call.
``get(transform(array(x), v -> ...), 0)`` evaluates ``x`` once and names it ``v``; common
subexpressions are not shared inside lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.text import PARAM_DESCRIPTION_CHARS, WS_CLASS, is_blank

# How many parameters and enum values are shown.
MAX_PARAMS = 12
MAX_ENUM_VALUES = 6

# Texts shown instead of a parameter list.
NO_PARAMETERS = "no parameters"
UNPARSABLE = "unparsable schema"

_MARK = "_sha1_of_the_text"


def _let(value: str, name: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _single_object(raw: str, fields: str) -> str:
    parsed = (
        f"from_json(concat('[', {raw}, ',{{\"{_MARK}\":\"', sha1({raw}), '\"}}]'),"
        f" 'array<struct<{fields}, `{_MARK}`: string>>', map('allowSingleQuotes', 'false'))"
    )
    return _let(
        parsed, "p", f"case when size(p) = 2 and get(p, 1).`{_MARK}` = sha1({raw}) then get(p, 0) end"
    )


def _schema(raw: str) -> str:
    return _single_object(raw, "properties: map<string, variant>, required: variant")


def is_json_object(raw: str) -> Column:
    """True when the text is one JSON object. Reads no field, so nothing is copied."""
    return F.expr(f"{_single_object(raw, '`_`: variant')} is not null")


def is_unparsable(raw: str) -> Column:
    """Non-blank text that is not a JSON object; blank text does not count."""
    return ~is_blank(F.col(raw)) & ~is_json_object(raw)


def parse_schema(raw: str) -> Column:
    """``struct<properties: map<string, variant>, required: variant>`` or null."""
    return F.expr(_schema(raw))


def _entries(schema: str) -> str:
    """``array<struct<key, value>>``; a repeated name keeps its first place and last value."""
    last = (
        f"transform(array_distinct(map_keys({schema}.properties)), k -> struct(k as key, element_at("
        f"filter(map_entries({schema}.properties), e -> e.key = k), -1).value as value))"
    )
    repeated = (
        f"size(array_distinct(map_keys({schema}.properties))) < size(map_keys({schema}.properties))"
    )
    return f"case when {repeated} then {last} else map_entries({schema}.properties) end"


def _required(schema: str) -> str:
    """The string members of ``required``; empty when it is not a list."""
    members = f"try_variant_get({schema}.required, '$', 'array<variant>')"
    strings = f"filter({members}, v -> schema_of_variant(v) = 'STRING')"
    return f"coalesce(transform({strings}, v -> cast(v as string)), cast(array() as array<string>))"


def property_entries(schema: str) -> Column:
    return F.expr(_entries(schema))


def required_names(schema: str) -> Column:
    return F.expr(_required(schema))


def _float(v: str) -> str:
    """A JSON number with a point or an exponent, spelled as Python spells a float."""
    number = f"try_variant_get({v}, '$', 'double')"
    # Java writes 1.0E7 from ten million on; the decimal spelling is the plain one.
    plain = "regexp_replace(cast(cast(d as decimal(38,20)) as string), '([.][0-9]+?)0+$', '$1')"
    power = "cast(regexp_extract(cast(d as string), 'E-?([0-9]+)$', 1) as int)"
    scientific = (
        "concat(regexp_replace(cast(d as string), '([.]0)?E.*$', ''),"
        f" if(abs(d) < 1, 'e-', 'e+'), if({power} < 10, '0', ''), cast({power} as string))"
    )
    return _let(number, "d", f"""case
      when isnan(d) then 'nan' when abs(d) = double('inf') then if(d > 0, 'inf', '-inf')
      when d = 0 then '0.0'
      when abs(d) >= 1e-4D and abs(d) < 1e16D then {plain}
      else {scientific} end""")


def _scalar(v: str) -> str:
    """One JSON value as shown text: ``True``/``False``/``None``, floats with a point or an exponent."""
    kind = f"schema_of_variant({v})"
    # A whole number beyond 64 bits is a decimal without places as well.
    is_float = f"({kind} = 'DOUBLE' or {kind} like 'DECIMAL%' and not ({kind} like '%,0)' and length(cast({v} as string)) > 18))"
    return f"""case
      when {kind} = 'STRING' then cast({v} as string)
      when {kind} = 'BOOLEAN' then initcap(cast({v} as string))
      when {kind} = 'VOID' then 'None'
      when {is_float} then {_float(v)}
      else cast({v} as string) end"""


def _parts(entry: str, required: str) -> dict[str, str]:
    """SQL for the parts of one property."""
    spec = f"{entry}.value"
    is_object = f"coalesce(startswith(schema_of_variant({spec}), 'OBJECT<'), false)"

    def field(key: str) -> str:
        return f"variant_get({spec}, '$.{key}', 'variant')"

    scalar = _scalar("v")
    type_hint = f"""case when {is_object} then {_let(field('type'), 't', f'''case
        when schema_of_variant(t) is null or schema_of_variant(t) = 'VOID' then
          case when {field('enum')} is not null then 'enum'
            when {field('oneOf')} is not null or {field('anyOf')} is not null then 'union'
            else 'any' end
        when startswith(schema_of_variant(t), 'ARRAY<') then
          array_join(transform(try_variant_get(t, '$', 'array<variant>'), v -> {scalar}), '|')
        else {_scalar('t')} end''')} end"""
    enum_preview = f"""case when {is_object} then {_let(
        f"try_variant_get({spec}, '$.enum', 'array<variant>')", 'l',
        f'''case when size(l) > 0 then
          array_join(transform(slice(l, 1, {MAX_ENUM_VALUES}), v -> {scalar}), ', ') end''')} end"""
    # Whitespace only at the ends after collapsing, so plain trim is enough.
    text = f"""case when {is_object} and schema_of_variant({field('description')}) = 'STRING' then
        nullif(substring(trim(regexp_replace(
          cast({field('description')} as string), r'{WS_CLASS}+', ' ')), 1, {PARAM_DESCRIPTION_CHARS}), '')
        end"""
    return {
        "is_object": is_object,
        "type_hint": type_hint,
        "required": f"array_contains({required}, {entry}.key)",
        "enum_preview": enum_preview,
        "description": text,
    }


def _line(name: str, parts: dict[str, str]) -> str:
    return (
        f"concat('- ', {name}, ' (', coalesce(concat({parts['type_hint']}, ', '), ''),"
        f" case when {parts['required']} then 'required' else 'optional' end, ')',"
        f" coalesce(concat(' enum[', {parts['enum_preview']}, ']'), ''),"
        f" coalesce(concat(': ', {parts['description']}), ''))"
    )


def param_parts(entry: str, required: str) -> dict[str, Column]:
    """Columns for one exploded property: its parts under their names."""
    return {name: F.expr(sql) for name, sql in _parts(entry, required).items()}


def param_line(name: str, required: str, type_hint: str, enum_preview: str, description: str) -> Column:
    """The shown line from the columns that hold the parts."""
    return F.expr(
        _line(name, {"required": required, "type_hint": type_hint,
                     "enum_preview": enum_preview, "description": description})
    )


def _overflow(n: str) -> str:
    return (
        f"case when {n} > {MAX_PARAMS} then"
        f" concat('- ... and ', cast({n} - {MAX_PARAMS} as string), ' more parameter(s)') end"
    )


def overflow_line(n_params: str) -> Column:
    """The closing line when there are more parameters than are shown, else null."""
    return F.expr(_overflow(n_params))


def render_params(raw: str) -> Column:
    """The whole parameter list as text, within the row (no shuffle)."""
    lines = f"transform(slice(b.entries, 1, {MAX_PARAMS}), e -> {_line('e.key', _parts('e', 'b.required'))})"
    listing = (
        f"case when size(b.entries) > 0 then concat_ws('\\n', {lines}, {_overflow('size(b.entries)')})"
        f" else '{NO_PARAMETERS}' end"
    )
    bound = _let(f"struct({_entries('s')} as entries, {_required('s')} as required)", "b", listing)
    parsed = _let(
        _schema(raw), "s", f"case when s is null then '{UNPARSABLE}' else {bound} end"
    )
    return F.when(is_blank(F.col(raw)), F.lit(NO_PARAMETERS)).otherwise(F.expr(parsed))
