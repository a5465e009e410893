"""Training-data operators: quality rules, secret and personal-data scans, decontamination, exact
and near duplicates, license scans, token files and packing. Nothing outside this subpackage
imports it (``__spark_entry__`` adds its queries when it is there)."""
