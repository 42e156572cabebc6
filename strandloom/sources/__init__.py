"""Readers and writers of alignments, genomes and the steps' text formats."""
