"""Registered queries of the operators: name -> (query, SQL or None)."""
from . import checks_dedup, checks_lang, checks_mix, checks_pack, checks_runs, checks_search, checks_spelling, checks_text

CHECKS = {**checks_text.CHECKS, **checks_dedup.CHECKS, **checks_mix.CHECKS, **checks_pack.CHECKS, **checks_search.CHECKS, **checks_runs.CHECKS, **checks_lang.CHECKS, **checks_spelling.CHECKS}
