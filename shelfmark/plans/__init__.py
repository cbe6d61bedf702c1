"""The Silver builds, the Gold outputs and the quality reports."""
