"""The queries and SQL that ``__spark_entry__`` adds: importing the operators registers them."""

from cohortflow.llm import conversation_repair, decontamination, license_scan, lines, minhash_docs, packing, personal_data, phrases, quality, secrets_scan, substrings, token_counts, token_files  # noqa: F401
from cohortflow.llm.common import QUERIES, SQL  # noqa: F401
