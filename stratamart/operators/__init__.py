"""DataFrame-to-DataFrame operators shared by the layer builds."""
