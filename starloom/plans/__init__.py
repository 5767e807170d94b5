"""Ready-made queries and the warehouse build, composed from the operators."""
