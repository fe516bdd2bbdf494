"""Ready-made catalogues and feature plans for known datasets."""
