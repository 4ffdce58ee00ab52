"""Views, searches and analytic jobs composed of the operators."""
