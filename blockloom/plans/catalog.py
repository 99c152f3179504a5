"""The events: where each field of a log sits, which contracts emit it, and the stored column types derived from that."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Contract addresses.
CONTRACTS = {
    "ConditionalTokens": "0x4d97dcd97ec945f40cf65f87097ace5ea0476045",
    "CTFExchange": "0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e",
    "NegRiskCtfExchange": "0xc5d563a36ae78145c45a50134d48a1215220f80a",
    "NegRiskAdapter": "0xd91e80cf2e7be2e162c6513ced06f1dd0da35296",
    "UmaCtfAdapter": "0x157ce2d672854c848c9b79c49a8cc6cc89176a49",
    "FeeModuleCTF": "0xe3f18acc55091e2c48d883fc8c8413319d4ab7b0",
    "FeeModuleNegRisk": "0xb768891e3130f6df18214ac804d4db76c2c37730",
}
CT, NR, UMA = ("ConditionalTokens",), ("NegRiskAdapter",), ("UmaCtfAdapter",)
EXCHANGES, FEE_MODULES = ("CTFExchange", "NegRiskCtfExchange"), ("FeeModuleCTF", "FeeModuleNegRisk")

# Event name, stored name, contracts, signature hash, and the columns in stored order as "name type place";
# t1..t3 are indexed topics, d0.. words of the data. Types: b32 hash, addr address, token id stored as 32 bytes, u256 and
# i256 decimal strings, u32 small integer, u256[] array, bytes.
_EVENTS = (
    ("condition_preparation", "condition_preparation", CT, "ab3760c3bd2bb38b5bcf54dc79802ed67338b4cf29f3054ded67ed24661e4177", "condition_id b32 t1, oracle addr t2, question_id b32 t3, outcome_slot_count u32 d0"),
    ("condition_resolution", "condition_resolution", CT, "b44d84d3289691f71497564b85d4233648d9dbae8cbdbb4329f301c3a0185894", "condition_id b32 t1, oracle addr t2, question_id b32 t3, outcome_slot_count u32 d0, payout_numerators u256[] d1"),
    ("ct_position_split", "position_split", CT, "2e6bb91f8cbcda0c93623c54d0403a43514fabc40084ec96b6d5379a74786298", "stakeholder addr t1, collateral_token addr d0, parent_collection_id b32 t2, condition_id b32 t3, partition u256[] d1, amount u256 d2"),
    ("ct_positions_merge", "positions_merge", CT, "6f13ca62553fcc2bcd2372180a43949c1e4cebba603901ede2f4e14f36b282ca", "stakeholder addr t1, collateral_token addr d0, parent_collection_id b32 t2, condition_id b32 t3, partition u256[] d1, amount u256 d2"),
    ("ct_payout_redemption", "payout_redemption", CT, "2682012a4a4f1973119f1c9b90745d1bd91fa2bab387344f044cb3586864d18d", "redeemer addr t1, collateral_token addr t2, parent_collection_id b32 t3, condition_id b32 d0, index_sets u256[] d1, payout u256 d2"),
    ("order_filled", "order_filled", EXCHANGES, "d0a08e8c493f9c94f29311604c9de1b4e8c8d4c06bd0c789af57f2d65bfec0f6", "order_hash b32 t1, maker addr t2, taker addr t3, maker_asset_id token d0, taker_asset_id token d1, maker_amount_filled u256 d2, taker_amount_filled u256 d3, fee u256 d4"),
    ("orders_matched", "orders_matched", EXCHANGES, "63bf4d16b7fa898ef4c4b2b6d90fd201e9c56313b65638af6088d149d2ce956c", "taker_order_hash b32 t1, taker_order_maker addr t2, maker_asset_id token d0, taker_asset_id token d1, maker_amount_filled u256 d2, taker_amount_filled u256 d3"),
    ("fee_charged", "fee_charged", EXCHANGES, "acffcc86834d0f1a64b0d5a675798deed6ff0bcfc2231edd3480e7288dba7ff4", "receiver addr t1, token_id token d0, amount u256 d1"),
    ("order_cancelled", "order_cancelled", EXCHANGES, "5152abf959f6564662358c2e52b702259b78bac5ee7842a0f01937e670efcc7d", "order_hash b32 t1"),
    ("token_registered", "token_registered", EXCHANGES, "bc9a2432e8aeb48327246cddd6e872ef452812b4243c04e6bfb786a2cd8faf0d", "token0 token t1, token1 token t2, condition_id b32 t3"),
    ("market_prepared", "market_prepared", NR, "f059ab16d1ca60e123eab60e3c02b68faf060347c701a5d14885a8e1def7b3a8", "market_id b32 t1, oracle addr t2, fee_bips u32 d0, data bytes d1"),
    ("question_prepared", "question_prepared", NR, "aac410f87d423a922a7b226ac68f0c2eaf5bf6d15e644ac0758c7f96e2c253f7", "market_id b32 t1, question_id b32 t2, index_val u32 d0, data bytes d1"),
    ("outcome_reported", "outcome_reported", NR, "9e9fa7fd355160bd4cd3f22d4333519354beff1f5689bde87f2c5e63d8d484b2", "market_id b32 t1, question_id b32 t2, outcome u32 d0"),
    ("nr_position_split", "position_split", NR, "bbed930dbfb7907ae2d60ddf78345610214f26419a0128df39b6cc3d9e5df9b0", "stakeholder addr t1, condition_id b32 t2, amount u256 d0"),
    ("nr_positions_merge", "positions_merge", NR, "ba33ac50d8894676597e6e35dc09cff59854708b642cd069d21eb9c7ca072a04", "stakeholder addr t1, condition_id b32 t2, amount u256 d0"),
    ("positions_converted", "positions_converted", NR, "b03d19dddbc72a87e735ff0ea3b57bef133ebe44e1894284916a84044deb367e", "stakeholder addr t1, market_id b32 t2, index_set u256 t3, amount u256 d0"),
    ("nr_payout_redemption", "payout_redemption", NR, "9140a6a270ef945260c03894b3c6b3b2695e9d5101feef0ff24fec960cfd3224", "redeemer addr t1, condition_id b32 t2, amounts u256[] d0, payout u256 d1"),
    ("question_initialized", "question_initialized", UMA, "eee0897acd6893adcaf2ba5158191b3601098ab6bece35c5d57874340b64c5b7", "question_id b32 t1, request_timestamp u32 t2, creator addr t3, ancillary_data bytes d0, reward_token addr d1, reward u256 d2, proposal_bond u256 d3"),
    ("question_resolved", "question_resolved", UMA, "566c3fbdd12dd86bb341787f6d531f79fd7ad4ce7e3ae2d15ac0ca1b601af9df", "question_id b32 t1, settled_price i256 t2, payouts u256[] d0"),
    ("question_reset", "question_reset", UMA, "7981b5832932948db4e32a4a16a0f44b2ce7ff088574afb9364b313f70f82e8f", "question_id b32 t1"),
    ("question_flagged", "question_flagged", UMA, "2435a0347185933b12027c6f394a5fd9c03646dba233e956f50658719dfc0b35", "question_id b32 t1"),
    ("question_emergency_resolved", "question_emergency_resolved", UMA, "6edb5841a476c9c29c34a652d1a44f785fe71a6157a3da9a6a6a589a1bd2945a", "question_id b32 t1, payouts u256[] d0"),
    ("fee_refunded", "fee_refunded", FEE_MODULES, "b608d2bf25d8b4b744ba23ce2ea9802ea955e216c064a62f42152fbf98958d24", "order_hash b32 t1, receiver addr t2, token_id token d0, refund u256 d1, fee_charged u256 t3"),
)


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    place: str


@dataclass(frozen=True)
class Event:
    key: str
    name: str
    contracts: tuple[str, ...]
    topic0: str
    fields: tuple[Field, ...]

    @property
    def topics(self) -> list[Field]:
        return sorted((f for f in self.fields if f.place[0] == "t"), key=lambda f: f.place)

    @property
    def words(self) -> list[Field]:
        return sorted((f for f in self.fields if f.place[0] == "d"), key=lambda f: f.place)


EVENTS = {key: Event(key, name, contracts, "0x" + topic, tuple(Field(*f.split()) for f in spec.split(", "))) for key, name, contracts, topic, spec in _EVENTS}
#: (contract, stored event) -> event: the 29 stored tables.
TABLES = {(c, e.name): e for e in EVENTS.values() for c in e.contracts}
COMMON = ("block_number", "transaction_index", "transaction_hash", "log_index")
STORED = {"b32": T.BinaryType(), "addr": T.BinaryType(), "token": T.BinaryType(), "u32": T.LongType()}


def stored_schema(contract: str, event: str) -> T.StructType:
    """Columns of a stored table, without the two partition columns."""
    common = [T.StructField(c, T.BinaryType() if c == "transaction_hash" else T.LongType()) for c in COMMON]
    return T.StructType(common + [T.StructField(f.name, STORED.get(f.kind, T.StringType())) for f in TABLES[contract, event].fields])


RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("address", "blockNumber", "transactionHash", "transactionIndex", "logIndex")] + [T.StructField("topics", T.ArrayType(T.StringType())), T.StructField("data", T.StringType())])
