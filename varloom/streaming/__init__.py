"""Record-level operators over a growing folder of VCF files."""
