"""Layer-to-layer plans composed from the operators."""
