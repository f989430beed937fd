from .checks import (
    all_checks,
    script_types_present,
    share_dropped,
    skip_decision,
    sources_loaded,
    split_balance,
    train_size,
    unified_table,
    verdict,
)
from .cleaning import (
    apply_cleaning,
    clean_rows,
    cleaned,
    cleaning_report,
    dedup_first,
    dropped_by_source,
    length_filter,
    retokenised,
    tag_alignment,
    tag_alignments,
)
from .ids import dense_ids, in_load_order, renumber, unify
from .reports import (
    counts_by,
    distinct_values,
    distribution,
    first_per_group,
    id_null_checks,
    ids_unique,
    length_sketches,
    length_stats,
    load_counts,
    ordered_counts,
    script_by_split,
    script_pivot,
    source_by_split,
    sketched_medians,
    summary,
    tag_vocab,
    wide_counts,
)
from .sinks import (
    outputs_check,
    read_csv,
    read_parquet,
    write_csv,
    write_outputs,
    write_parquet,
)
from .splits import assign_splits, has_split, split_totals, stratum_sizes
