"""The JSON schemas of what comes in from models and of what goes out to readers.

Fixed values: names of fields, and the values that they may have.
"""

from __future__ import annotations

ENTITY_TYPES = ["Org", "Person", "Program", "Tool", "Model", "Dataset", "Benchmark", "Paper", "Repo", "Document", "Tech", "Topic", "Event", "Location", "Other"]
RELATION_TYPES = [
    "MENTIONS", "CITES", "ANNOUNCES", "REPORTED_BY", "LAUNCHED", "PUBLISHED", "UPDATED", "FUNDED", "PARTNERED_WITH", "ACQUIRED", "HIRED", "CREATED", "OPERATES", "GOVERNED_BY", "GOVERNS", "REGULATES",
    "COMPLIES_WITH", "USES_TECH", "USES_MODEL", "USES_DATASET", "TRAINED_ON", "EVALUATED_ON", "INTEGRATES_WITH", "DEPENDS_ON", "REQUIRES", "PRODUCES", "MEASURES", "AFFECTS", "PREDICTS", "DETECTS", "MONITORS",
]
KINDS = ["asserted", "inferred", "hypothesis"]
POLARITIES = ["pos", "neg", "unclear"]
MODALITIES = ["observed", "planned", "speculative"]
RESOLUTIONS = ["exact", "range", "anchored_to_published", "unknown"]

TEXT, WHOLE, REAL, FLAG = ({"type": t} for t in ("string", "integer", "number", "boolean"))


def maybe(schema: dict) -> dict:
    """The schema of a value that may be null."""
    return schema | {"type": [schema["type"], "null"]}


def listed(values: list) -> dict:
    return TEXT | {"enum": values}


def several(items: dict) -> dict:
    return {"type": "array", "items": items}


def record(needed: dict, **other: dict) -> dict:
    """An object: the members that it needs, and others that it may have."""
    return {"type": "object", "required": list(needed), "properties": needed | other}


def extraction(entity_types: list[str] = ENTITY_TYPES, relation_types: list[str] = RELATION_TYPES) -> dict:
    """What a model answers about a document. Asserted relations need evidence."""
    time = record({}, text=TEXT, start=maybe(TEXT), end=maybe(TEXT), anchor=maybe(TEXT), resolution=maybe(TEXT) | {"enum": [*RESOLUTIONS, None]})
    entity = record({"name": TEXT, "type": listed(entity_types)}, aliases=several(TEXT), externalIds={"type": "object", "additionalProperties": TEXT}, idHint=maybe(TEXT))
    evidence = record({"docId": TEXT, "url": TEXT, "snippet": TEXT}, published=maybe(TEXT), charSpan=record({"start": WHOLE, "end": WHOLE}))
    relation = record(
        {"source": TEXT, "rel": listed(relation_types), "target": TEXT, "kind": listed(KINDS), "confidence": REAL | {"minimum": 0, "maximum": 1}},
        verbRaw=maybe(TEXT), polarity={"oneOf": [listed(POLARITIES), {"type": "null"}]}, modality={"oneOf": [listed(MODALITIES), {"type": "null"}]}, time=time, evidence=several(evidence),
    )
    relation |= {"if": {"properties": {"kind": {"const": "asserted"}}}, "then": {"required": ["evidence"], "properties": {"evidence": {"minItems": 1}}}}
    lists = {"entities": several(entity), "relations": several(relation), "techTerms": several(TEXT), "dates": several(time)}
    return record({"docId": TEXT, "extractorVersion": TEXT} | lists, notes=several(TEXT))


_COUNT, _PLACE = WHOLE | {"minimum": 0}, WHOLE | {"minimum": 1}
#: A row of the movers view. All members are there; some may be null.
MOVER = record({
    "entity_id": TEXT, "label": TEXT, "type": TEXT | {"minLength": 1}, "current_rank": _PLACE, "rank_prior": maybe(_PLACE), "rank_delta": maybe(WHOLE), "is_new": FLAG,
    "velocity_raw": maybe(REAL), "velocity_ci_lower": maybe(REAL | {"minimum": 0}), "sustained": FLAG, "bridge_delta": maybe(REAL), "mention_count_7d": _COUNT, "mention_count_30d": _COUNT,
    "first_seen": TEXT, "days_since_first_seen": _COUNT, "distinct_sources_7d": _COUNT, "in_trending_view": FLAG, "trend_score": REAL,
})
#: The head of the movers view.
MOVERS_META = record(
    {
        "view": TEXT | {"const": "movers"}, "domain": TEXT, "rank_window_days": _PLACE, "rowCount": _COUNT, "exportedAt": TEXT,
        "dateRange": record({"start": maybe(TEXT), "end": TEXT}) | {"additionalProperties": False},
        "scoring": record({"novelty_decay_lambda": REAL, "min_mentions_for_velocity": WHOLE}, velocity_ci=record({}, method=TEXT, z=REAL, one_sided=FLAG, continuity_correction=REAL), sustained_windows=WHOLE),
    }
)
