"""All registered queries of this folder."""

from ledgerloom.llm import (  # noqa: F401
    chat,
    collocations,
    decontamination,
    langid,
    lm,
    mixing,
    neardup,
    packing,
    quality,
    rules,
    suffixes,
    toxicity,
    tries,
)
from ledgerloom.llm.common import QUERIES, SQL  # noqa: F401
