from .array_csv import read_array_csv, rows_to_sentences
from .conll import lines_to_sentences, read_conll
from .id_files import file_kinds, inspect_id_only, sample_ids, task_verdicts
from .manifest import (
    SourceFile,
    empty_source,
    load_report,
    locate,
    manifest_frame,
    missing_files,
    missing_from,
    split_files,
)
