"""The curated datasets as one lazily built set."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from siltstone.operators.bridge import AddressDictionary
from siltstone.operators.match import exact_match, fuzzy_match, unmatched
from siltstone.plans import commercial, party
from siltstone.sources.stage import staging
from siltstone.sources.tables import materialize


class Curated:
    """Curated datasets by name.

    ``raw`` maps ``"<system>.<raw table>"`` (see ``siltstone.plans.raw``) to DataFrames, plus
    ``landing.opportunityteammember`` and ``landing.user``.  A dataset is built when first asked for
    and reads its siblings as attributes, so the attribute accesses are the dependency graph and each
    dataset is built once.  With ``addresses``, a dictionary kept from run to run, only addresses that no run has met
    yet are parsed.
    """

    TABLES = {
        "location": "Distinct addresses of all sites with their standard form",
        "equipment": "Generators of the ERP and of the control system",
        "opportunity": "CRM opportunities",
        "site": "Sites of the ERP and the control system, matched on standard addresses",
        "account": "Top-level CRM accounts, control-system and ERP customers, matched by name and number",
        "customer": "ERP customers and child CRM accounts, matched by number",
        "employee": "CRM users with their managers and current ERP person records",
        "opportunity_team_member": "Members of opportunity teams with names",
    }

    def __init__(self, raw: Mapping[str, DataFrame], addresses: AddressDictionary | None = None):
        self.raw, self.addresses = raw, addresses

    def store(self, name: str, target: str, catalog_name: str | None = None) -> DataFrame:
        """Write one dataset; datasets built later read the stored form.

        What was staged for it is deleted, and what it was built from is built again if asked for.
        """
        before = set(self.__dict__)
        with staging() as drop:
            built = getattr(self, name)
            order = party.account_order() if name == "account" else ()
            stored = materialize(built, target, catalog_name, "curated", self.TABLES.get(name), order_by=order)
            drop(built.sparkSession)
        for other in set(self.__dict__) - before:
            del self.__dict__[other]
        self.__dict__[name] = stored
        return stored

    # party

    @cached_property
    def users(self) -> DataFrame:
        return party.crm_users(self.raw["crm.user"])

    @cached_property
    def erp_customers(self) -> DataFrame:
        return party.erp_customers(self.raw["erp.customer_info"])

    @cached_property
    def control_customers(self) -> DataFrame:
        return party.control_customers(self.raw["control.customer"])

    @cached_property
    def crm_accounts(self) -> DataFrame:
        return party.crm_accounts(self.raw["crm.account"], self.users)

    @cached_property
    def top_accounts(self) -> DataFrame:
        return party.top_accounts(self.crm_accounts)

    @cached_property
    def exact_matches(self) -> DataFrame:
        return exact_match(*party.account_sides(self.top_accounts, self.control_customers))

    @cached_property
    def unmatched_accounts(self) -> DataFrame:
        return unmatched(*party.account_sides(self.top_accounts, self.control_customers))

    @cached_property
    def unmatched_control_customers(self) -> DataFrame:
        crm, control = party.account_sides(self.top_accounts, self.control_customers)
        return unmatched(control, crm)

    @cached_property
    def close_matches(self) -> DataFrame:
        return fuzzy_match(*party.account_sides(self.unmatched_accounts, self.unmatched_control_customers))

    @cached_property
    def _remaining(self) -> tuple[DataFrame, DataFrame]:
        return party.remaining_accounts(self.top_accounts, self.control_customers)

    @cached_property
    def remaining_accounts(self) -> DataFrame:
        return self._remaining[0]

    @cached_property
    def remaining_control_customers(self) -> DataFrame:
        return self._remaining[1]

    @cached_property
    def matched_accounts(self) -> DataFrame:
        return party.matched_accounts(self.top_accounts, self.control_customers)

    @cached_property
    def account(self) -> DataFrame:
        return party.account(self.matched_accounts, self.erp_customers)

    @cached_property
    def customer(self) -> DataFrame:
        return party.customer(party.child_accounts(self.crm_accounts), self.erp_customers)

    @cached_property
    def employee(self) -> DataFrame:
        return party.employee(self.users, self.raw["erp.company_person_last_change"])

    # commercial

    @cached_property
    def erp_locations(self) -> DataFrame:
        return commercial.erp_locations(self.raw["erp.location_party_address_pub"])

    @cached_property
    def control_sites(self) -> DataFrame:
        return commercial.control_sites(self.raw["control.site"], self.raw["control.state"])

    @cached_property
    def control_generators(self) -> DataFrame:
        return commercial.control_generators(self.raw["control.generator"])

    @cached_property
    def location(self) -> DataFrame:
        if self.addresses is not None:
            return self.addresses.of(self.control_sites, self.erp_locations)
        return commercial.location(self.control_sites, self.erp_locations)

    @cached_property
    def erp_generators(self) -> DataFrame:
        return commercial.erp_generators(self.raw["erp.equipment_functional_cfv"])

    @cached_property
    def ps_generators(self) -> DataFrame:
        return self.erp_generators.where(F.col("identifier") == commercial.PS_GENERATORS)

    @cached_property
    def erg_generators(self) -> DataFrame:
        return self.erp_generators.where(F.col("identifier") == commercial.ERG_GENERATORS)

    @cached_property
    def equipment(self) -> DataFrame:
        return commercial.equipment(self.erp_generators, self.control_generators)

    @cached_property
    def opportunity(self) -> DataFrame:
        return commercial.opportunity(self.raw["crm.opportunity"])

    @cached_property
    def erp_sites(self) -> DataFrame:
        return commercial.erp_sites(self.raw["erp.equipment_functional_cfv"], self.erp_locations)

    @cached_property
    def ps_sites(self) -> DataFrame:
        return self.erp_sites.where(F.col("identifier") == commercial.PS_SITES)

    @cached_property
    def opco_sites(self) -> DataFrame:
        return self.erp_sites.where(F.col("identifier") == commercial.OPCO_SITES)

    @cached_property
    def pre_erp_sites(self) -> DataFrame:
        return self.erp_sites.where(F.col("identifier") == commercial.PRE_IFS_SITES)

    @cached_property
    def site(self) -> DataFrame:
        bridge = None if self.addresses is None else self.addresses.of(self.control_sites, self.erp_locations)
        return commercial.site(self.erp_sites, self.control_sites, bridge)

    @cached_property
    def opportunity_team_member(self) -> DataFrame:
        return commercial.opportunity_team_member(
            self.raw["landing.opportunityteammember"], self.raw["landing.user"], self.opportunity, self.employee
        )
