"""The warehouse's operators: silver, gold, the order view and the reports."""
