"""Item and type dictionaries of permit notices, their checks, and the small dimension tables made of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed values. One line for each item: code | name | scope | value type | series | flags (core, virtual, extract-only) | synonyms.
ITEMS = """
BODY_AGNCY_NM | 고시기관 | attachment | TEXT |  | extract-only | 기관; 고시기관; 관리청; 처분청
NOTI_NO | 고시번호 | attachment | TEXT |  |  | 고시번호; 공고번호
NOTI_DT | 고시일자 | attachment | DATE |  |  | 고시일; 고시일자; 고시연월일; 공고일; 공고일자; 공고연월일
NOTI_TTL | 제목 | attachment | TEXT |  |  | 제목; 고시명; 공고명
NOTI_PSN | 고시자 | attachment | TEXT |  | extract-only | 고시자; 공고자
LOC | 점용·사용 장소 | attribute | TEXT | 위치 | core | 장소; 점용·사용장소; 위치; 점·사용의장소; 점용장소; 점용·사용의장소; 점·사용위치; 점용위치; 장소(번지선); 점·사용장소; 점용·사용위치; 점사용의장소; 점사용장소; 소재지; 점용지번; 사업위치; 발견장소
AREA | 점용·사용 면적 | attribute | TEXT | 면적 | core | 면적(㎡); 면적; 점·사용의면적; 점용면적; 점용·사용면적; 점용·사용의면적; 점·사용면적; 허가면적; 점용·사용면적(㎡); 점용면적(㎡); 허가면적(㎡); 사용면적
PRPS | 점용·사용 목적 | attribute | TEXT |  | core | 목적; 점·사용의목적; 점용·사용목적; 점용목적; 점용·사용의목적; 점·사용목적; 점사용의목적; 사용목적
APLC_NM | 허가·승인 대상자 성명 | attribute | TEXT | 인적 | core | 성명; 피허가자; 신청인; 피허가자성명; 피승인자; 허가를 받은 자; 피협의자; 허가대상자; 피승인자성명; 성명(상호); 점용·사용 허가를 받은 자; 신고자; 피협의자성명; 성명(명칭); 신고인; 신청자; 대상자; 허가 받은 자; 수허가자; 승인 받은 자; 상호; 명칭; 대표자; 점용·사용자
WORK_PRD | 점용·사용 기간 | attribute | DTRG | 기간 | core,virtual | 기간; 허가기간; 점·사용의기간; 점용기간; 점용·사용기간; 점용허가의유효기간; 점용·사용의기간; 점·사용기간; 사용기간
APLC_ADDR | 허가·승인 대상자 주소 | attribute | TEXT | 주소 | core | 주소; 피허가자주소; 피승인자주소; 피협의자주소; 신고자 주소; 사업자 주소
APV_NO | 허가·승인번호 | attribute | TEXT |  |  | 허가번호; 승인번호; 협의번호; 신고번호; 허가(협의)번호; 수리번호; 허가증번호
APV_DT | 허가·승인일자 | attribute | DATE |  |  | 허가연월일; 허가일자; 허가일; 승인연월일; 실시계획승인일; 승인일자; 실시계획신고수리일; 승인일; 실시계획승인일자; 수리일; 협의연월일; 수리일자; 수리연월일; 협의일자; 협의일; 실시계획신고수리일자; 처분일자; 점용·사용허가일
RMRK | 비고 | attribute | TEXT |  |  | 비고; 기타; 참고사항
SBJT_ADDR | 공고·처분 대상자 주소 | attribute | TEXT | 주소 |  | 
BSNS_CTNT | 사업내용 | attribute | TEXT |  |  | 공사내용; 공사개요; 사업내용; 사업개요; 준공시설
CNST_PRD | 공사시행 기간 | attribute | DTRG | 기간 |  | 공사기간; 공사시행기간; 착수및준공예정일
CHG_AFT | 변경 후 값 | attribute | TEXT |  |  | 변경; 변경후
CHG_SMRY | 변경사항 | attribute | TEXT |  |  | 변경사항; 변경내용
SBJT_NM | 공고·처분 대상자 성명 | attribute | TEXT | 인적 |  | 처분대상자
CHG_BFR | 변경 전 값 | attribute | TEXT |  |  | 당초; 변경전
WTR_TY | 수면 종류 | attribute | TEXT |  |  | 수면의종류; 수면 종류
STRC_TY | 공작물 종류 | attribute | TEXT |  |  | 공작물의종류; 공작물 종류
CMPL_DT | 준공·완료 처리일자 | attribute | DATE | 날짜 |  | 준공검사확인증발급일자; 공사완료신고수리일; 준공검사일; 준공검사확인증발급일
OPER_NM | 사업 시행자 성명 | attribute | TEXT | 인적 |  | 시행자; 공사시행자; 공사시행자의 성명; 사업시행자
PRPS_CTNT | 점용·사용 목적·사업내용(복합) | attribute | TEXT |  |  | 점용의목적및개요; 목적및사유; 공사의 목적 및 개요
CNTC_PNT | 문의처 | attribute | TEXT | 연락 |  | 문의처; 문의
APV_NO_DT | 허가·승인번호·일자(복합) | attribute | TEXT |  |  | 
CNST_NM | 공사명칭 | attribute | TEXT |  |  | 공사명; 공사명칭; 사업명
CNST_LOC | 공사시행 장소 | attribute | TEXT | 위치 |  | 공사장소; 공사위치; 공사시행 장소
CNTC_NO | 연락처 | attribute | TEXT | 연락 |  | 전화번호; 연락처; 팩스번호
PRJ_COST | 사업비 | attribute | TEXT |  |  | 총사업비; 사업비
APV_CTNT | 허가내용 | attribute | TEXT |  |  | 허가내용
CNST_AREA | 공사시행 면적 | attribute | TEXT | 면적 |  | 공사면적; 공사시행 면적
CNST_TY | 공사종류 | attribute | TEXT |  |  | 공사의 종류; 공사종류
LAND_PLAN | 토지이용계획 | attribute | TEXT |  |  | 토지이용; 토지이용계획
CNCL_DT | 취소일자 | attribute | DATE | 날짜 |  | 허가취소일; 취소일자; 취소일
CMPL_AREA | 준공면적 | attribute | TEXT | 면적 |  | 준공면적
CNCL_RSN | 취소사유 | attribute | TEXT | 사유 |  | 처분사유; 취소사유
NOTI_PRD | 공고기간 | attribute | DTRG | 기간 |  | 공고기간
DSPS_CTNT | 처분내용 | attribute | TEXT |  |  | 처분내용
NOTI_SBJT | 공고대상 | attribute | TEXT |  |  | 공고사항; 공고대상
DSPS_RSN | 처분사유 | attribute | TEXT | 사유 |  | 처분의원인이되는사실
OPIN_SBMS | 의견제출 기간·방법 | attribute | TEXT |  |  | 의견제출; 제출방법; 의견제출 기간; 의견제출 방법
LAW_BASE | 근거법령 | attribute | TEXT |  |  | 근거법령
"""

# Fixed values. One line for each type of notice: code | name | family | priority | rules (a rule is words that must all occur).
TYPES = """
OCU_PRM | 점용·사용 허가 | 점용·사용 | 43 | 허가
OCU_APV | 점용·사용 승인 | 점용·사용 | 42 | 승인
ETC_CMP_ACP | 준공·완료 수리 | 기타 | 78 | 준공검사; 준공; 공사완료+신고; 완료+수리
OCU_CHG_PRM | 변경허가 | 점용·사용 | 57 | 변경+허가
OCU_CNS | 점용·사용 협의 | 점용·사용 | 41 | 협의
IMP_APV | 실시계획 승인 | 실시계획 | 79 | 실시계획+승인
IMP_RAC | 실시계획 신고수리 | 실시계획 | 83 | 실시계획+신고+수리
IMP_CHG_APV | 실시계획 변경승인 | 실시계획 | 84 | 실시계획+변경+승인
OCU_EXN_PRM | 기간연장 변경허가 | 점용·사용 | 69 | 기간연장+변경+허가; 연장+변경+허가
MIX_CA | 협의·승인 혼합 | 혼합 | 0 | 
OCU_CHG | 점용·사용 변경 | 점용·사용 | 44 | 점사용+변경
OCU_CHG_APV | 변경승인 | 점용·사용 | 56 | 변경+승인
IMP_RPT | 실시계획 신고 | 실시계획 | 80 | 실시계획+신고
IMP_APV_RPT | 실시계획 승인·신고 병기 | 실시계획 | 81 | 실시계획+승인+신고
OCU_PRM_CNC | 허가취소 | 점용·사용 | 66 | 허가+취소
OCU_GEN | 점용·사용 일반 | 점용·사용 | 40 | 점사용
OCU_CHG_CNS | 변경협의 | 점용·사용 | 55 | 변경+협의
ETC_ABD_RMV | 방치선박·물건 제거 | 기타 | 77 | 방치선박; 방치+물건+제거
IMP_CHG_RPT | 실시계획 변경신고 | 실시계획 | 85 | 실시계획+변경+신고
IMP_CHG_RAC | 실시계획 변경신고수리 | 실시계획 | 86 | 실시계획+변경+신고+수리
MIX_PC | 허가·협의 혼합 | 혼합 | 0 | 
ETC_PRM_EXM | 허가 면제기준 | 기타 | 76 | 면제
FEE_RED | 점용료·사용료 감면 | 점용료·사용료 | 88 | 점사용료+감면; 사용료+감면
RCL_LCN | 매립면허 | 매립 | 90 | 매립면허; 매립+면허
FEE_CAL | 점용료·사용료 산정 | 점용료·사용료 | 87 | 점사용료+산정; 사용료+산정
MIX_PA | 허가·승인 혼합 | 혼합 | 0 | 
MIX_CHG_PC | 변경허가·협의 혼합 | 혼합 | 0 | 
ETC_LAW_ENA | 법령·조례 제·개정 | 기타 | 75 | 법령+개정; 조례+개정; 규칙+개정
ETC_RGT_TRF | 권리·의무 이전 | 기타 | 74 | 권리+이전; 의무+이전; 권리+의무+승계
RCL_CMP | 매립 준공 | 매립 | 95 | 매립+준공
MIX_CHG_PA | 변경허가·승인 혼합 | 혼합 | 0 | 
MIX_PCA | 허가·협의·승인 혼합 | 혼합 | 0 | 
ETC_UPL_DCS | 도시·군관리계획 결정·변경 | 기타 | 73 | 군관리계획; 도시관리계획
OCU_EXN_APV | 기간연장 변경승인 | 점용·사용 | 68 | 기간연장+변경+승인; 연장+변경+승인
IMP_ETC | 실시계획 기타 | 실시계획 | 58 | 실시계획
RIM_CHG_APV | 매립 실시계획 변경승인 | 매립 | 93 | 매립+실시계획+변경+승인
MIX_CHG_CA | 변경협의·승인 혼합 | 혼합 | 0 | 
ETC_VIO_DSP | 법 위반 행정처분 | 기타 | 72 | 위반+행정처분; 위반+처분
ETC_RMD_ORD | 개축·철거 명령 | 기타 | 71 | 철거+명령; 개축+명령; 원상회복+명령
MIX_CHG_PCA | 변경허가·협의·승인 혼합 | 혼합 | 0 | 
RCL_BSC_PLN | 매립 기본계획 | 매립 | 91 | 매립+기본계획
OCU_NEW_PRM | 신규허가 | 점용·사용 | 63 | 신규+허가
ETC_ADM_NOT | 기타 행정공고 | 기타 | 0 | 
RCL_ETC | 매립 기타 | 매립 | 60 | 매립
RCL_APV | 매립 승인 | 매립 | 89 | 매립+승인
OCU_APV_CNC | 승인취소 | 점용·사용 | 65 | 승인+취소
ETC_AGR_EXT | 골재·해사채취 | 기타 | 70 | 골재; 해사채취
RIM_APV | 매립 실시계획 승인 | 매립 | 92 | 매립+실시계획+승인
OCU_NEW_APV | 신규승인 | 점용·사용 | 62 | 신규+승인
RIM_CHG_ATH | 매립 실시계획 변경인가 | 매립 | 94 | 매립+실시계획+변경+인가
OCU_EXN_CNS | 기간연장 변경협의 | 점용·사용 | 67 | 기간연장+변경+협의; 연장+변경+협의
FEE_GEN | 점용료·사용료 일반 | 점용료·사용료 | 59 | 점사용료; 사용료
IMP_RPT_CNC | 실시계획 신고취소 | 실시계획 | 82 | 실시계획+신고+취소
OCU_CNC_UNK | 점용·사용 취소(유형불명) | 점용·사용 | 45 | 점사용+취소
OCU_CNS_CNC | 협의취소 | 점용·사용 | 64 | 협의+취소
ETC_BID_NOT | 입찰공고 | 기타 | 10 | 입찰
"""

@dataclass(frozen=True)
class Item:
    code: str
    name: str
    scope: str
    value_type: str
    series: str | None
    core: bool
    virtual: bool
    stored: bool
    synonyms: tuple[str, ...]
    order: int


@dataclass(frozen=True)
class NoticeType:
    code: str
    name: str
    family: str
    priority: int
    rules: tuple[tuple[str, ...], ...]


def items(text: str = ITEMS) -> list[Item]:
    out = []
    for i, line in enumerate(x for x in text.strip().split("\n")):
        code, name, scope, kind, series, flags, words = (p.strip() for p in (line + " ").split(" | "))
        out.append(Item(code, name, scope, kind, series or None, "core" in flags, "virtual" in flags, "extract-only" not in flags, tuple(w.strip() for w in words.split(";") if w.strip()), i))
    return out


def types(text: str = TYPES) -> list[NoticeType]:
    out = []
    for line in text.strip().split("\n"):
        code, name, family, priority, rules = (p.strip() for p in (line + " ").split(" | "))
        out.append(NoticeType(code, name, family, int(priority), tuple(tuple(w.strip() for w in r.split("+")) for r in rules.split(";") if r.strip())))
    return out


def check_items(found: list[tuple[str, tuple[str, ...], str]]) -> None:
    """Raises on what makes a dictionary ambiguous; found: (code, normalised synonyms, remark on an empty list)."""
    owner: dict[str, str] = {}
    codes = [f[0] for f in found]
    if len(set(codes)) < len(codes):
        raise ValueError("an item is there twice: " + ", ".join(sorted({c for c in codes if codes.count(c) > 1})))
    for code, words, remark in found:
        if not words and not remark:
            raise ValueError(f"{code} has no synonyms and does not say why")
        for w in words:
            if not w:
                raise ValueError(f"{code} has a synonym that is nothing once normalised")
            if owner.setdefault(w, code) != code:
                raise ValueError(f"{w} belongs to {owner[w]} and {code}")


def check_types(found: list[NoticeType]) -> None:
    seen_codes, seen_names, seen = set(), set(), {}
    for t in found:
        if not (t.code and t.name and t.family):
            raise ValueError(f"a type lacks a field: {t}")
        if t.code in seen_codes or t.name in seen_names:
            raise ValueError(f"a type is there twice: {t.code}")
        seen_codes.add(t.code)
        seen_names.add(t.name)
        if any(not w for r in t.rules for w in r):
            raise ValueError(f"{t.code} has an empty rule")
        if t.rules and seen.setdefault(t.priority, t.code) != t.code:
            raise ValueError(f"{t.code} and {seen[t.priority]} have one priority")


#: Items without synonyms on purpose: their labels are told by context only.
WITHOUT_SYNONYMS = ("SBJT_ADDR", "APV_NO_DT")


def item_dim(spark: SparkSession) -> DataFrame:
    """A row for each item that is a value of an attachment: item_cd, item_nm, series, value_type, core_yn, item_ord."""
    rows = [(i.code, i.name, i.series, i.value_type, "Y" if i.core else "N", i.order) for i in items() if i.scope == "attribute"]
    return spark.createDataFrame(rows, "item_cd string, item_nm string, series string, value_type string, core_yn string, item_ord int")


def field_dim(spark: SparkSession) -> DataFrame:
    """A row for each item of either scope: item_cd, scope, stored, virtual, item_ord."""
    return spark.createDataFrame([(i.code, i.scope, i.stored, i.virtual, i.order) for i in items()], "item_cd string, scope string, stored boolean, virtual boolean, item_ord int")


def type_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.code, t.name, t.family, t.priority) for t in types()], "type_cd string, type_nm string, family string, priority int")


_NORMAL: list[tuple[str, str]] = []


def synonym_dim(spark: SparkSession) -> DataFrame:
    """label, item_cd: what labels look up, normalised once by the function that lookups use; an inline table of under 200 rows."""
    from tidemark.functions.text import normalise_label

    if not _NORMAL:
        rows = [(w, i.code) for i in items() for w in i.synonyms]
        found = spark.createDataFrame(rows, "word string, item_cd string").select(normalise_label("word").alias("label"), "item_cd").distinct()
        _NORMAL.extend((r["label"], r["item_cd"]) for r in found.collect())
    inline = ", ".join(f"('{label}', '{code}')" for label, code in sorted(_NORMAL))
    return spark.sql(f"SELECT * FROM VALUES {inline} AS t(label, item_cd)")


def checked(spark: SparkSession) -> None:
    """Fails fast where the dictionaries contradict themselves."""
    found: dict[str, list[str]] = {i.code: [] for i in items()}
    for r in synonym_dim(spark).collect():  # under 200 rows
        found[r["item_cd"]].append(r["label"])
    check_items([(c, tuple(w), "by context" if c in WITHOUT_SYNONYMS else "") for c, w in found.items()])
    check_types(types())
