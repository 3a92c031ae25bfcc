
INVENTORY: dict[str, list[str]] = {
    "A1": ["vcf_ingest"],
    "A2": ["sample_sheet_scan"],
    "A3": ["rename_map_scan", "dimension_scan", "strain_lookup_scan"],
    "A4": ["make_bins"],
    "A5": ["segment_scan"],
    "A6": ["mask_scan", "strain_count"],
    "A7": ["annotation_scan"],
    "A8": ["table_sink"],
    "A9": ["collate_runs"],
    "A10": ["collect_tables"],
    "B1": ["subset_samples"],
    "B2": ["polymorphic_sites"],
    "B3": ["site_counts"],
    "B4": ["rename_samples", "isotype_variants"],
    "B5": ["filter_snps", "snv_site_counts"],
    "B6": ["genotype_only"],
    "B7": ["list_samples"],
    "B8": ["filter_regions"],
    "B9": ["merge_multiallelic"],
    "B10": ["target_sites"],
    "B11": ["exclude_sites"],
    "B12": ["alt_carriers"],
    "B13": ["complete_sites"],
    "B14": ["biallelic_sites"],
    "B15": ["assign_ids"],
    "B16": ["ancestor_bed"],
    "B17": ["interval_annotate"],
    "B18": ["drop_flagged"],
    "B19": ["singletons"],
    "B20": ["ld_r2"],
    "B21": ["ld_prune"],
    "B22": ["recode_dosage"],
    "B23": ["marker_table", "individual_table"],
    "C1": ["interval_count"],
    "C2": ["interval_mean_depth"],
    "C3": ["assemble_mask", "mask_divergent_regions"],
    "C4": ["interval_overlap_join"],
    "D1": ["coverage_fraction"],
    "D2": ["classify_bins"],
    "D3": ["two_flank_rescue"],
    "D4": ["cluster_bins"],
    "D5": ["cluster_gaps"],
    "D6": ["fill_gaps"],
    "D7": ["recluster"],
    "D8": ["divergent_frequency", "divergent_frequency_classes"],
    "D9": ["drop_deletions"],
    "D10": ["strain_regions"],
    "D11": ["total_divergent_size"],
    "D12": ["divergence_stats"],
    "D13": ["strain_size"],
    "D14": ["bins_by_class"],
    "D15": ["population_regions"],
    "D16": ["strain_order"],
    "D17": ["divergent_regions"],
    "E1": ["ibd_markers", "ibd_marker_ld_filter"],
    "E2": ["ibd_segments", "ibd_segments_filtered"],
    "E3": ["breakpoint_intervals"],
    "E4": ["segment_interval_join"],
    "E5": ["haplotype_components"],
    "E6": ["haplotype_frequencies"],
    "E7": ["haplotype_homozygosity"],
    "E8": ["membership_matrix"],
    "E9": ["drop_singleton_haplotypes"],
    "E10": ["sharing_rank"],
    "E11": ["name_haplotypes"],
    "E12": ["melt_haplotypes"],
    "E13": ["haplotype_counts"],
    "E15": ["condense_runs"],
    "E16": ["swept_haplotype"],
    "E17": ["sweep_metrics"],
    "E18": ["haplotype_output"],
    "E19": ["sweep_summary", "ibd_sweep_summary"],
    "E20": ["haplotype_share"],
    "E21": ["haplotype_length_histogram"],
    "E22": ["haplotype_plot_rects", "haplotype_plot_labels"],
    "F1": ["alignment_sites"],
    "F2": ["site_counters"],
    "F3": ["iupac_consensus"],
    "F4": ["resolve_heterozygous"],
    "F5": ["binary_matrix"],
    "F6": ["alignment_by_strain"],
    "F7": ["alignment_text", "alignment_fasta", "alignment_nexus", "alignment_bin_nexus"],
    "F8": ["pairwise_distance"],
    "G1": ["pca_input"],
    "G2": ["normalize_genotypes"],
    "G3": ["relatedness"],
    "G4": ["pca"],
    "G5": ["pca_outlier_removal"],
    "G6": ["tracy_widom"],
    "G7": ["variance_explained"],
    "G8": ["pc_pairs"],
    "G9": ["parameter_sweep", "pca_sweep", "pca_outlier_sweep"],
}
