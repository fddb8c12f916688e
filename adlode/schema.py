"""Table layouts."""

from pyspark.sql import types as T


def _layout(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

LISTING_FIELDS = ("title", "company", "city", "experience", "skills_raw", "description", "url", "date_posted", "source")

LISTING = _layout(**dict.fromkeys(LISTING_FIELDS, _S))
RAW = _layout(id=_L, hash=_S, **dict.fromkeys(LISTING_FIELDS, _S), scraped_at=T.TimestampType())
TAXONOMY = _layout(canonical=_S, aliases=_S, category=_S)
CLEAN = _layout(
    raw_id=_L, hash=_S, title=_S, company=_S, city=_S, experience=_S, language=_S, skills_raw=_S,
    skills_extracted=_S, skill_count=_I, description=_S, url=_S, date_posted=_S, source=_S,
    scraped_at=T.TimestampType(),
)
FREQUENCY = _layout(skill=_S, count=_L, pct=_D)
RULES = _layout(if_skills=_S, then_skills=_S, support=_D, confidence=_D, lift=_D)
CLUSTERS = _layout(raw_id=_L, title=_S, cluster_id=_I, archetype=_S)
PROFILES = _layout(cluster_id=_I, archetype=_S, size=_L, top_skills=_S, pct_of_total=_D)
VERSIONS = _layout(number=_L, name=_S)
