"""Composition of the operators into datasets and into the build job."""
