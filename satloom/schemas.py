"""Column lists of the relations that the workflows read and write, as DDL."""

ENTRIES = "entry_id string, individual string, assembly_method string, phasing_status string, fasta_paths array<string>, trf_dat_paths array<string>"
LOCI = (
    "file_idx int, line_no long, source_seq string, start_pos long, end_pos long, period int, copy_number double, "
    "consensus_size int, percent_match double, entropy double, consensus string"
)
RM_OUT = (
    "line_no long, sw_score int, pct_divergence string, pct_deleted string, pct_inserted string, query_label string, query_start long, "
    "query_end long, strand string, repeat_name string, repeat_class_family string, repeat_begin long, repeat_end long, repeat_left long"
)
BED = "seqname string, start0 long, end0 long, name string, score string, strand string"
CLUSTERS = (
    "entry_id string, motif string, target_period int, window int, rank int, label string, n_input_sequences long, pct_of_bin double, "
    "consensus_length int, gc_content double, total_copy_number double, mean_percent_match double, mean_entropy double, consensus string"
)
