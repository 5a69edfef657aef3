"""All queries of this package: importing it registers them."""

from attesta.llm import alignment, licences, merkle, minhash, mixing, pieces, pii, quality, simhash, spotsigs, tokenids, urlfilter, warc  # noqa: F401
from attesta.llm.common import ORACLES, QUERIES  # noqa: F401
