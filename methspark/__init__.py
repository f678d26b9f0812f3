"""DataFrame operators for DNA-methylation calls."""
