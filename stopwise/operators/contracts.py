"""Contract checks of event JSON text.

The text is parsed once into a variant, which keeps the JSON types. Contracts
are tables of rules, from which conditions on columns are made; no Python runs
per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise import settings
from stopwise.functions.plan import Adding, computed_once, projected, projected_once

VIOLATIONS = "_violations"
MEETS = "_meets"

# Text formats.
_DATE_TIME = (
    r"^(?i)\d{4}-(0[1-9]|1[0-2])-\d{2}T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?"
    r"(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
)
_URI = r"^[A-Za-z][A-Za-z0-9+.-]*:([A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=]|%[0-9A-Fa-f]{2})*$"
_SERVICE_DATE = r"^[0-9]{8}$"
_SERVICE_TIME = r"^[0-9]{2,}:[0-5][0-9]:[0-5][0-9]$"

# Alert vocabularies.
CAUSES = (
    "UNKNOWN_CAUSE",
    "OTHER_CAUSE",
    "TECHNICAL_PROBLEM",
    "STRIKE",
    "DEMONSTRATION",
    "ACCIDENT",
    "HOLIDAY",
    "WEATHER",
    "MAINTENANCE",
    "CONSTRUCTION",
    "POLICE_ACTIVITY",
    "MEDICAL_EMERGENCY",
)
EFFECTS = (
    "NO_SERVICE",
    "REDUCED_SERVICE",
    "SIGNIFICANT_DELAYS",
    "DETOUR",
    "ADDITIONAL_SERVICE",
    "MODIFIED_SERVICE",
    "OTHER_EFFECT",
    "UNKNOWN_EFFECT",
    "STOP_MOVED",
    "NO_EFFECT",
    "ACCESSIBILITY_ISSUE",
)
SEVERITIES = ("UNKNOWN_SEVERITY", "INFO", "WARNING", "SEVERE")
FAILURE_STAGES = ("producer", "schema_validation", "spark_transform", "sink")


# Named text formats of rules.
_FORMATS = {
    "instant": _DATE_TIME,
    "uri": _URI,
    "service_date": _SERVICE_DATE,
    "service_time": _SERVICE_TIME,
}


@dataclass(frozen=True)
class Rule:
    """What one field may hold. ``kinds`` are JSON types."""

    kinds: tuple[str, ...]
    required: bool = False
    equals: str | int | None = None
    choices: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    min_items: int | None = None
    form: str | None = None
    one_of: tuple[str, ...] = ()


# Formats that no number's or boolean's text has, so a text that has one is a string.
_TELLING = ("instant", "uri", "service_time")


# A contract: rules by path. ``payload.x`` is a field of the payload, ``x[]``
# an item of a list, ``x[].y`` a field of such an item.
Contract = dict[str, Rule]


def _text(**limits) -> Rule:
    return Rule(("string",), **limits)


def _maybe(kind: str, **limits) -> Rule:
    return Rule((kind, "null"), **limits)


def _instant(**limits) -> Rule:
    return _text(form="instant", **limits)


def _maybe_instant(**limits) -> Rule:
    return _maybe("string", form="instant", **limits)


def _identity(event_type: str) -> dict[str, Rule]:
    return {
        "event_id": _text(required=True, min_length=1),
        "event_type": _text(required=True, equals=event_type),
        "schema_version": Rule(("number",), required=True, equals=settings.SCHEMA_VERSION),
    }


def _header(event_type: str) -> dict[str, Rule]:
    return {
        **_identity(event_type),
        "source": _text(required=True, equals=settings.EVENT_SOURCE),
        "source_timestamp": _instant(required=True),
        "feed_timestamp": _instant(required=True),
        "ingested_at": _instant(required=True),
        "published_at": _instant(required=True),
    }


def _direction(**limits) -> Rule:
    return _maybe("integer", minimum=0, maximum=1, **limits)


def _inside(path: str, rules: Contract) -> Contract:
    return {f"{path}.{name}": rule for name, rule in rules.items()}


_OBJECT = Rule(("object",), required=True)


def _list(**limits) -> Rule:
    return Rule(("array",), required=True, **limits)


VEHICLE: Contract = {
    **_header(settings.VEHICLE_EVENT),
    "route_id": _maybe("string"),
    "trip_id": _maybe("string"),
    "vehicle_id": _text(required=True, min_length=1),
    "payload": _OBJECT,
    **_inside(
        "payload",
        {
            "latitude": Rule(("number",), required=True, minimum=-90, maximum=90),
            "longitude": Rule(("number",), required=True, minimum=-180, maximum=180),
            "bearing": _maybe("number", minimum=0, maximum=360),
            "odometer": _maybe("number", minimum=0),
            "speed_mps": _maybe("number", minimum=0),
            "direction_id": _direction(),
            "current_stop_sequence": _maybe("integer", minimum=0),
            "stop_id": _maybe("string"),
            "current_status": _maybe("string"),
            "occupancy_status": _maybe("string"),
            "vehicle_label": _maybe("string"),
        },
    ),
}

TRIP: Contract = {
    **_header(settings.TRIP_EVENT),
    "route_id": _maybe("string"),
    "trip_id": _text(required=True, min_length=1),
    "start_date": _maybe("string", form="service_date"),
    "start_time": _maybe("string", form="service_time"),
    "vehicle_id": _maybe("string"),
    "payload": _OBJECT,
    **_inside(
        "payload",
        {
            "direction_id": _direction(required=True),
            "schedule_relationship": _maybe("string", required=True),
            "trip_delay_seconds": _maybe("integer", required=True),
            "stop_time_updates": _list(),
            "stop_time_updates[]": Rule(("object",), one_of=("stop_id", "stop_sequence")),
            **_inside(
                "stop_time_updates[]",
                {
                    "stop_id": _maybe("string", required=True, min_length=1),
                    "stop_sequence": _maybe("integer", required=True, minimum=0),
                    "predicted_arrival": _maybe_instant(required=True),
                    "predicted_departure": _maybe_instant(required=True),
                    "delay_seconds": _maybe("integer", required=True),
                    "schedule_relationship": _maybe("string", required=True),
                },
            ),
        },
    ),
}

ALERT: Contract = {
    **_header(settings.ALERT_EVENT),
    "alert_id": _text(required=True, min_length=1),
    "payload": _OBJECT,
    **_inside(
        "payload",
        {
            "cause": _maybe("string", required=True, choices=CAUSES),
            "effect": _maybe("string", required=True, choices=EFFECTS),
            "severity": _maybe("string", required=True, choices=SEVERITIES),
            "header_text": _maybe("string", required=True),
            "description_text": _maybe("string", required=True),
            "tts_header_text": _maybe("string"),
            "tts_description_text": _maybe("string"),
            "url": _maybe("string", required=True, form="uri"),
            "active_periods": _list(),
            "active_periods[]": Rule(("object",)),
            **_inside(
                "active_periods[]",
                {"start": _maybe_instant(required=True), "end": _maybe_instant(required=True)},
            ),
            "informed_entities": _list(min_items=1),
            "informed_entities[]": Rule(("object",)),
            **_inside(
                "informed_entities[]",
                {
                    "agency_id": _maybe("string", required=True),
                    "route_id": _maybe("string", required=True),
                    "route_type": _maybe("integer", required=True, minimum=0),
                    "trip_id": _maybe("string", required=True),
                    "stop_id": _maybe("string", required=True),
                    "direction_id": _direction(required=True),
                },
            ),
        },
    ),
}

DEAD_LETTER: Contract = {
    **_identity(settings.DEAD_LETTER_EVENT),
    "failed_at": _instant(required=True),
    "failure_stage": _text(required=True, choices=FAILURE_STAGES),
    "error_type": _text(required=True, min_length=1),
    "error_message": _text(required=True, min_length=1),
    "original_topic": _text(required=True, min_length=1),
    "original_partition": _maybe("integer"),
    "original_offset": _maybe("integer"),
    "original_key": _maybe("string"),
    "original_schema_version": _maybe("integer"),
    "raw_payload": Rule(("string", "object", "array", "null")),
    "correlation_id": _maybe("string"),
}

CONTRACTS = {
    (settings.VEHICLE_EVENT, 1): VEHICLE,
    (settings.TRIP_EVENT, 1): TRIP,
    (settings.ALERT_EVENT, 1): ALERT,
    (settings.DEAD_LETTER_EVENT, 1): DEAD_LETTER,
}

_FIELDS = "map<string,variant>"
_NAMES = "map<string,struct<`-`:boolean>>"
_ITEMS = "array<variant>"
_NO_TEXTS = "array<string>"
_SCALARS = ("VOID", "STRING", "BOOLEAN")
_CHUNK = 7  # fields per step
_HEADS = {"string": ("ST",), "boolean": ("BO",), "null": ("VO",), "array": ("AR",), "object": ("OB",)}
_NUMBERS = ("BI", "DE", "DO", "FL")  # begins of the types of JSON numbers


def _fields(value: Column, path: str = "$") -> Column:
    """Fields of an object; null for anything else."""
    return F.try_variant_get(value, path, _FIELDS)


def _names(value: Column, path: str = "$") -> Column:
    """Field names of an object, whose values are not copied; null for anything else."""
    return F.map_keys(F.try_variant_get(value, path, _NAMES))


def _items(value: Column, path: str = "$") -> Column:
    """Items of a list; null for anything else."""
    return F.try_variant_get(value, path, _ITEMS)


def _inner(contract: Contract, place: str) -> Contract:
    """Rules of the fields directly at a place, by name."""
    cut = f"{place}." if place else ""
    named = {path[len(cut) :]: rule for path, rule in contract.items() if path.startswith(cut)}
    return {name: rule for name, rule in named.items() if "." not in name and "[]" not in name}


def _lists(contract: Contract) -> list[str]:
    """Names of the lists of the payload whose items have rules."""
    ends = [path for path in contract if path.endswith("[]")]
    return sorted(path.removeprefix("payload.").removesuffix("[]") for path in ends)


def _facts(value: Column, path: str, rules: Contract, known: dict[str, Column]) -> list[Column]:
    """What the rules of an object at a path need: per field the type and the value that is
    limited, each taken from the document itself. ``known`` are fields that are already unpacked,
    as they are long."""
    facts = []
    for name, rule in rules.items():
        place = f"{path}.{name}"
        kind = F.schema_of_variant(F.try_variant_get(value, place, "variant"))
        if name in known:
            kind = F.when(known[name].isNotNull(), F.lit(rule.kinds[0].upper())).otherwise(kind)
        facts.append(kind.alias(f"kind_{name}"))
        if {"integer", "number"} & set(rule.kinds):
            facts.append(F.try_variant_get(value, place, "double").alias(f"number_{name}"))
        if isinstance(rule.equals, str) or rule.choices or rule.min_length or rule.form:
            facts.append(F.try_variant_get(value, place, "string").alias(f"text_{name}"))
        if rule.min_items is not None:
            items = known[name] if name in known else _items(value, place)
            facts.append(F.size(items).alias(f"size_{name}"))
    return facts


def _missing(prefix: str, facts: Column, rules: Contract) -> list[Column]:
    """Per required name a violation, or null; null for each where there is no object."""
    return [
        F.when(
            facts["names"].isNotNull() & facts[f"kind_{name}"].isNull(),
            F.lit(f"{prefix}{name}: missing"),
        )
        for name, rule in rules.items()
        if rule.required
    ]


def _present(facts: Column, rules: Contract) -> Column:
    """How many of the known fields are there."""
    return sum((facts[f"kind_{name}"].isNotNull().cast("int") for name in rules), F.lit(0))


def _problems(prefix: str, facts: Column, rules: Contract) -> list[Column]:
    """Per field what is wrong with its value, or null."""
    return [_judged(f"{prefix}{name}", name, facts, rules[name]) for name in sorted(rules)]


def _allowed(kind: Column, number: Column | None, rule: Rule) -> Column:
    """Whether a value has one of the JSON types; a number without fraction is an integer."""
    conditions = []
    plain = [name for name in ("string", "boolean") if name in rule.kinds]
    plain = [name.upper() for name in plain] + ["VOID"] * ("null" in rule.kinds)
    if plain:
        conditions.append(kind.isin(*plain))
    conditions += [kind.startswith(x.upper()) for x in ("array", "object") if x in rule.kinds]
    if number is not None:
        numeric = ~(kind.isin(*_SCALARS) | kind.startswith("ARRAY") | kind.startswith("OBJECT"))
        whole = F.lit(True) if "number" in rule.kinds else F.coalesce(number % 1 == 0, F.lit(False))
        conditions.append(numeric & whole)
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found


def _judged(path: str, name: str, facts: Column, rule: Rule) -> Column:
    """Only the conditions of its own JSON type are asked of a value."""
    kind = facts[f"kind_{name}"]
    number = facts[f"number_{name}"] if {"integer", "number"} & set(rule.kinds) else None
    reasons = [(~_allowed(kind, number, rule), "wrong type")]
    is_text = kind == "STRING"

    def text() -> Column:
        return facts[f"text_{name}"]

    if isinstance(rule.equals, str):
        reasons.append((is_text & (text() != rule.equals), "unexpected value"))
    elif rule.equals is not None:
        reasons.append((number != float(rule.equals), "unexpected value"))
    if rule.choices:
        reasons.append((is_text & ~text().isin(*rule.choices), "not an allowed value"))
    if rule.min_length:
        reasons.append((is_text & (F.length(text()) < rule.min_length), "too short"))
    if rule.form:
        reasons.append((is_text & ~_form_ok(text(), rule.form), "malformed"))
    if rule.minimum is not None:
        reasons.append((number < float(rule.minimum), "below minimum"))
    if rule.maximum is not None:
        reasons.append((number > float(rule.maximum), "above maximum"))
    if rule.min_items is not None:
        too_few = kind.startswith("ARRAY") & (facts[f"size_{name}"] < rule.min_items)
        reasons.append((too_few, "too few items"))
    # The type of a field that is not there is null, and no condition holds.
    found = F.when(kind.isNull(), F.lit(None).cast("string"))
    for condition, reason in reasons:
        found = found.when(condition, F.lit(f"{path}: {reason}"))
    return found


def _form_ok(text: Column, form: str) -> Column:
    matches = text.rlike(_FORMATS[form])
    return matches & F.substring(text, 1, 10).try_cast("date").isNotNull() if form == "instant" else matches


def _unknown(names: Column, rules: Contract) -> Column:
    """Field names without a rule; none for a null object."""
    known = F.array(*(F.lit(name) for name in rules)) if rules else F.array().cast(_NO_TEXTS)
    return F.coalesce(F.array_except(names, known), F.array().cast(_NO_TEXTS))


def _said(names: Column, prefix: Column) -> Column:
    said = F.transform(names, lambda name: F.concat(prefix, name, F.lit(": unknown field")))
    return F.coalesce(said, F.array().cast(_NO_TEXTS))


def _with_unknown(problems: Column, unknown: Column, prefix: str) -> Column:
    """Problems by field name, with those of unknown fields."""
    both = F.concat(F.array_compact(problems), _said(unknown, F.lit(prefix)))
    return F.when(F.size(unknown) == 0, problems).otherwise(F.array_sort(both))


def _item_facts(items: Column, rules: Contract) -> Column:
    """Facts of each item of a list of the payload."""
    return F.transform(
        items,
        lambda item: F.struct(_names(item).alias("names"), *_facts(item, "$", rules, {})),
    )


def _item_wrong(item: Column, contract: Contract, place: str, said_as: str = "") -> Column:
    """What is wrong with an item itself, or null."""
    rule = contract[place]
    wrong = F.when(item["names"].isNull(), F.lit(f"{said_as}{place}: wrong type"))
    if rule.one_of:
        none = F.lit(True)
        for name in rule.one_of:
            none = none & (item[f"kind_{name}"] == "VOID")
        wrong = wrong.when(none, F.lit(f"{said_as}{place}: one of its fields is needed"))
    return wrong


def _any_item_bad(found: Column, contract: Contract, place: str) -> Column:
    """Whether an item of a list has any violation."""
    rules, prefix = _inner(contract, place), f"{place}."

    def bad(item: Column) -> Column:
        texts = [
            _item_wrong(item, contract, place),
            *_missing(prefix, item, rules),
            *_problems(prefix, item, rules),
        ]
        return F.coalesce(*texts).isNotNull() | (F.size(item["names"]) > _present(item, rules))

    return F.coalesce(F.exists(found, bad), F.lit(False))


def _item_violations(
    found: Column, contract: Contract, place: str, said_as: str
) -> tuple[Column, Column, Column]:
    """Of the items of a list: missing names, problems of the items, problems of their fields."""
    rules, prefix = _inner(contract, place), f"{said_as}{place}."

    def flat(per_item) -> Column:
        return F.coalesce(F.flatten(F.transform(found, per_item)), F.array().cast(_NO_TEXTS))

    def fields(item: Column) -> Column:
        problems = F.array(*_problems(prefix, item, rules))
        return _with_unknown(problems, _unknown(item["names"], rules), prefix)

    missing = flat(lambda item: F.array(*_missing(prefix, item, rules)))
    judged = flat(lambda item: F.array(_item_wrong(item, contract, place, said_as)))
    return missing, judged, flat(fields)


def _odd_violations(payload: Column, odd: Column, said_as: str) -> tuple[Column, Column]:
    """Of the items of lists of the payload that have no rules, and of their fields: all are unknown."""

    def each(per_item) -> Column:
        def of(name: Column) -> Column:
            items = _items(F.try_element_at(payload, name))
            said = F.flatten(F.transform(items, lambda item: per_item(name, item)))
            return F.coalesce(said, F.array().cast(_NO_TEXTS))

        return F.flatten(F.transform(F.array_compact(odd), of))

    items = each(lambda name, item: F.array(F.concat(F.lit(f"{said_as}payload."), name, F.lit("[]: unknown field"))))
    fields = each(
        lambda name, item: _said(
            F.map_keys(_fields(item)), F.concat(F.lit(f"{said_as}payload."), name, F.lit("[]."))
        )
    )
    return items, fields


def contract_of(document: Column) -> tuple[Column, Column]:
    """Event type (when text) and schema version (when an integer) of a variant."""
    kind = F.try_variant_get(document, "$.event_type", "variant")
    version = F.try_variant_get(document, "$.schema_version", "variant")
    return (
        F.when(F.schema_of_variant(kind) == "STRING", F.try_variant_get(kind, "$", "string")),
        F.when(F.schema_of_variant(version) == "BIGINT", F.try_variant_get(version, "$", "bigint")),
    )


def _label(kind: Column, version: Column) -> Column:
    return F.concat(kind, F.lit(" v"), version.cast("string"))


_GIVEN = "given"


def _judged_object(
    step: Callable[[str, Column], Column], name: str, prefix: str, names: Column, rules: Contract, facts
) -> dict[str, Column]:
    """Columns of an object: ``missing`` and ``wrong`` per field, ``array`` where it is a list,
    and ``present``, in steps of a few fields."""
    found, present = {}, F.lit(0)
    order = list(rules)
    for start in range(0, len(order), _CHUNK):
        some = {field: rules[field] for field in order[start : start + _CHUNK]}
        known = step(f"facts_{name}{start}", F.struct(names.isNotNull().alias("is"), *facts(some)))
        present = present + step(f"present_{name}{start}", _present(known, some))
        texts = {}
        for field, rule in some.items():
            kind = known[f"kind_{field}"]
            texts[f"wrong_{field}"] = _judged(f"{prefix}{field}", field, known, rule)
            texts[f"array_{field}"] = F.when(kind.startswith("ARRAY"), F.lit(field))
            if rule.required:
                gone = known["is"] & kind.isNull()
                texts[f"missing_{field}"] = F.when(gone, F.lit(f"{prefix}{field}: missing"))
        # A list, as fields of a struct that lambdas use are lost when plans are pruned.
        judged = step(f"judged_{name}{start}", F.array(*texts.values()))
        found |= {what: F.get(judged, F.lit(place)) for place, what in enumerate(texts)}
    return found | {"present": present}


def _of_contract(
    rows: DataFrame, number: int, contract: Contract, applies: Column, said_as: str, added: Adding
) -> tuple[DataFrame, dict]:
    """Rows with what one contract says of them, where it applies, short of texts.

    Each step is a generated column, as compiled code is kept per step and a step of
    a few fields is small enough to be compiled by the JVM as well. No step here has a lambda:
    those are not compiled.
    """
    document = F.col("_document")
    outer, inner, lists = _inner(contract, ""), _inner(contract, "payload"), _lists(contract)

    def step(name: str, value: Column) -> Column:
        nonlocal rows
        rows = added(rows, f"_{name}_{number}", F.when(applies, value))
        return F.col(f"_{name}_{number}")

    said = {"lists": {name: step(name, _items(document, f"$.payload.{name}")) for name in lists}}
    names, inside = F.col("_names"), F.col("_inside")
    whole = {"payload": inside} if "payload" in outer else {}
    said["root"] = _judged_object(
        step, "root", said_as, names, outer, lambda some: _facts(document, "$", some, whole)
    )
    said["payload"] = _judged_object(
        step,
        "payload",
        f"{said_as}payload.",
        inside,
        inner,
        lambda some: _facts(document, "$.payload", some, said["lists"]),
    )
    texts = [
        column
        for part in ("root", "payload")
        for name, column in said[part].items()
        if name.startswith(("missing_", "wrong_"))
    ]
    texts = [F.coalesce(*texts[i : i + 16]) for i in range(0, len(texts), 16)]
    unknown = F.coalesce(F.size(names), F.lit(0)) > said["root"]["present"]
    unknown_inside = F.coalesce(F.size(inside), F.lit(0)) > said["payload"]["present"]
    said["bad"] = step("bad", F.coalesce(*texts).isNotNull() | unknown | unknown_inside)
    return rows, said


def _violations(
    rows: DataFrame, number: int, contract: Contract, said: dict, said_as: str, added: Adding
) -> tuple[DataFrame, Column]:
    """Rows with facts of the items of lists, and the violations as texts; these are made only
    for messages that have any."""
    outer, inner, lists = _inner(contract, ""), _inner(contract, "payload"), _lists(contract)
    names, inside = F.col("_names"), F.col("_inside")
    bad, missing_items, bad_items, bad_fields = said["bad"], [], [], []
    for name in lists:
        place, column = f"payload.{name}[]", f"_items_{name}_{number}"
        rows = added(rows, column, _item_facts(said["lists"][name], _inner(contract, place)))
        found = F.col(column)
        bad = bad | _any_item_bad(found, contract, place)
        of_items = _item_violations(found, contract, place, said_as)
        for texts, one in zip((missing_items, bad_items, bad_fields), of_items, strict=True):
            texts.append(one)

    def texts_of(part: str, what: str, fields) -> list[Column]:
        return [said[part][f"{what}_{x}"] for x in fields if f"{what}_{x}" in said[part]]

    none = F.array().cast(_NO_TEXTS)
    missing = F.array(*texts_of("root", "missing", outer), *texts_of("payload", "missing", inner))
    wrong = F.array(*texts_of("root", "wrong", sorted(outer)))
    wrong_inside = F.array(*texts_of("payload", "wrong", sorted(inner))) if inner else none
    others = [name for name in sorted(inner) if name not in lists]
    arrays = F.array(*texts_of("payload", "array", others)) if others else none
    odd = F.concat(arrays, _unknown(inside, inner))
    odd_items, odd_fields = _odd_violations(_fields(F.col("_document"), "$.payload"), odd, said_as)
    texts = F.array_compact(
        F.concat(
            missing,
            *missing_items,
            _with_unknown(wrong, _unknown(names, outer), said_as),
            _with_unknown(wrong_inside, _unknown(inside, inner), f"{said_as}payload."),
            *bad_items,
            odd_items,
            *bad_fields,
            odd_fields,
        )
    )
    return rows, F.when(bad, texts).otherwise(none)


def _tells(rule: Rule) -> bool:
    """Whether a text that has the form or one of the values can only be a string."""
    words = rule.choices or ((rule.equals,) if isinstance(rule.equals, str) else ())
    if words:
        return all(word[:1].isalpha() and word not in ("true", "false") for word in words)
    return rule.form in _TELLING


def _text_holds(text: Column, rule: Rule) -> Column | None:
    """What the rule asks of a text, if anything."""
    conditions = []
    if isinstance(rule.equals, str):
        conditions.append(text == rule.equals)
    if rule.choices:
        conditions.append(text.isin(*rule.choices))
    if rule.min_length:
        conditions.append(F.length(text) >= rule.min_length)
    if rule.form:
        conditions.append(_form_ok(text, rule.form))
    return reduce(Column.__and__, conditions) if conditions else None


def _holds(value: Column, place: str, rule: Rule) -> Column:
    """Whether a field meets its rule, as ``_judged`` and ``_missing`` have it but without saying why.

    The field is looked up as seldom as its rule allows, and later conditions only where earlier ones hold.
    """
    kind = F.schema_of_variant(F.try_variant_get(value, place, "variant"))
    head = F.coalesce(F.substring(kind, 1, 2), F.lit(""))
    heads = [begin for name in rule.kinds if name in _HEADS for begin in _HEADS[name]]
    heads += [] if rule.required else [""]
    text = _text_holds(F.try_variant_get(value, place, "string"), rule)
    if text is not None and rule.kinds in (("string",), ("string", "null")) and _tells(rule):
        others = [begin for begin in heads if begin != "ST"]
        text = F.coalesce(text, F.lit(False))
        return text | head.isin(*others) if others else text
    numeric = bool({"integer", "number"} & set(rule.kinds))
    holds = head.isin(*heads, *(_NUMBERS if numeric else ()))
    if text is not None:
        holds = holds & ((head != "ST") | F.coalesce(text, F.lit(False)))
    if numeric:
        number = F.try_variant_get(value, place, "double")
        limits = []
        if "number" not in rule.kinds:
            limits.append(number % 1 == 0)
        if rule.equals is not None and not isinstance(rule.equals, str):
            limits.append(number == float(rule.equals))
        if rule.minimum is not None:
            limits.append(number >= float(rule.minimum))
        if rule.maximum is not None:
            limits.append(number <= float(rule.maximum))
        for limit in limits:
            holds = holds & F.coalesce(limit, F.lit(True))
    return holds


def _item_holds(item: Column, contract: Contract, place: str) -> Column:
    """Whether an item of a list meets its rules."""
    rules, rule = _inner(contract, place), contract[place]
    names = _names(item)
    parts = [names.isNotNull(), F.size(_unknown(names, rules)) == 0]
    parts += [_holds(item, f"$.{name}", one) for name, one in rules.items()]
    if rule.one_of:
        kinds = [F.schema_of_variant(F.try_variant_get(item, f"$.{name}", "variant")) for name in rule.one_of]
        parts.append(reduce(Column.__or__, [~kind.eqNullSafe("VOID") for kind in kinds]))
    return reduce(Column.__and__, parts)


def _met(rows: DataFrame, number: int, contract: Contract, applies: Column) -> tuple[DataFrame, Column]:
    """Rows with what decides whether a message meets a contract, and that as a column without lambdas
    for the fields and with one per list.

    A step holds the conditions of a few fields and is asked only where the steps before it hold.
    """
    document, names, inside = F.col("_document"), F.col("_names"), F.col("_inside")
    outer, inner, lists = _inner(contract, ""), _inner(contract, "payload"), _lists(contract)
    known = F.size(_unknown(names, outer)) == 0
    conditions = [known]
    if "payload" in outer:
        conditions += [inside.isNotNull(), F.size(_unknown(inside, inner)) == 0]
    conditions += [_holds(document, f"$.{x}", rule) for x, rule in outer.items() if x != "payload"]
    conditions += [
        _holds(document, f"$.payload.{x}", rule) for x, rule in inner.items() if x not in lists
    ]
    held = applies
    for start in range(0, len(conditions), _CHUNK):
        some = reduce(Column.__and__, conditions[start : start + _CHUNK])
        name = f"_holds{start}_{number}"
        rows = computed_once(rows, name, F.coalesce(F.when(held, some), F.lit(False)))
        held = F.col(name)
    for name in lists:
        column, place = f"_list_{name}_{number}", f"payload.{name}[]"
        rows = computed_once(rows, column, F.when(held, _items(document, f"$.payload.{name}")))
        items, rule = F.col(column), inner[name]
        each = F.forall(items, lambda item: _item_holds(item, contract, place))
        enough = F.size(items) >= (rule.min_items or 0)
        said = f"_holds_{name}_{number}"
        rows = rows.withColumn(said, F.coalesce(F.when(held & items.isNotNull() & enough, each), F.lit(False)))
        held = F.col(said)
    return rows, held


def with_verdict(messages: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Messages with whether they meet their contract: exactly those without violations do.

    No texts are made, so this is the cheaper question where only the answer is wanted.
    """
    rows, known = _opened(messages, contract)
    label = F.col("_label")
    found = F.lit(False)
    for number, (name, rules) in enumerate(known.items()):
        applies = F.col("_names").isNotNull() & (label == name)
        rows, held = _met(rows, number, rules, applies)
        found = F.when(label == name, held).otherwise(found)
    rows = projected_once(rows, MEETS, F.coalesce(found, F.lit(False)))
    return rows.select(*messages.columns, MEETS)


def _opened(
    messages: DataFrame, contract: Contract | None, added: Adding = computed_once
) -> tuple[DataFrame, dict[str, Contract]]:
    """Messages with their document, names of fields and the contract they name; and the contracts by name."""
    known = (
        {_GIVEN: contract}
        if contract is not None
        else {f"{kind} v{version}": found for (kind, version), found in CONTRACTS.items()}
    )
    document = F.col("_document")
    rows = added(messages, "_document", F.try_parse_json(F.col("value").cast("string")))
    kind, version = contract_of(document)
    named = _label(kind, version) if contract is None else F.lit(_GIVEN)
    parts = {"_label": named, "_names": _names(document), "_inside": _names(document, "$.payload")}
    for name, value in parts.items():
        rows = added(rows, name, value)
    return rows, known


def with_violations(
    messages: DataFrame, contract: Contract | None = None, *, if_read: bool = False
) -> DataFrame:
    """Messages (JSON text in ``value``) with their contract violations.

    The contract is the one the event names, unless one is given. Texts then
    read ``type vN at path: reason``. Conditions are made from the rules, and only
    those of a message's own contract are asked of it.

    With ``if_read`` all is projections, which cost nothing where the violations are not read. A filter on
    the violations is then to be put on a generated copy (``computed_once``), as it would be pushed below them.
    """
    plain, with_lambdas = (projected, projected) if if_read else (computed_once, projected_once)
    rows, known = _opened(messages, contract, plain)
    label = F.col("_label")
    kind, _ = contract_of(F.col("_document"))
    # What needs no lambda comes first for all contracts, so that it is compiled as one stage.
    prefixes = {name: "" if contract is not None else f"{name} at " for name in known}
    said = []
    for number, (name, rules) in enumerate(known.items()):
        applies = F.col("_names").isNotNull() & (label == name)
        rows, one = _of_contract(rows, number, rules, applies, prefixes[name], plain)
        said.append(one)
    found = F.lit(None).cast(_NO_TEXTS)
    for number, (name, rules) in enumerate(known.items()):
        rows, violations = _violations(
            rows, number, rules, said[number], prefixes[name], with_lambdas
        )
        found = F.when(label == name, violations).otherwise(found)
    if contract is None:
        found = (
            F.when(kind.isNull(), F.array(F.lit("event_type must be a string")))
            .when(label.isNull(), F.array(F.lit("schema_version must be an integer")))
            .when(
                ~label.isin(*known), F.array(F.concat(F.lit("Unsupported event schema: "), label))
            )
            .otherwise(found)
        )
    else:
        not_object = F.array(F.lit("<root>: not a JSON object"))
        found = F.when(F.col("_names").isNull(), not_object).otherwise(found)
    return with_lambdas(rows, VIOLATIONS, found).select(*messages.columns, VIOLATIONS)
